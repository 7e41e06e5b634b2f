"""A committee of logistic regressions on bootstrap rows and columns, all fitted together.

Every member is a Newton iteration on sums over its rows: a gradient and a Hessian. One read of the table adds up
those of all members (and, in the search for C, of all penalties and folds), so thirty members cost as many reads as
one. How often a member draws a row is a hash of the row's key and the member, worked out where the row is read, so
no sample is written down and a task that runs again draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larkspur.models.trees import Forest, _rows, _sum_blobs, _task, fit_extra_trees, unit
from larkspur.operators.neighbors import _vec
from larkspur.operators.split import bootstrap_columns
from larkspur.session import settle

C_GRID = (0.0001, 0.001, 0.01, 0.1, 1, 10, 100, 1000)


def poisson(u: np.ndarray, mean: np.ndarray | float) -> np.ndarray:
    """Poisson numbers from numbers in [0, 1); draws beyond 40 standard deviations do not occur."""
    mean = np.broadcast_to(np.asarray(mean, np.float64), u.shape)
    out, term = np.zeros(u.shape, np.int64), np.exp(-mean)
    total = term.copy()
    for k in range(1, int(mean.max(initial=0) + 40 * math.sqrt(mean.max(initial=0) + 1)) + 1):
        more = u >= total
        if not more.any():
            break
        out += more
        term = term * mean / k
        total += term
    return out


def draws(keys: np.ndarray, member: int, share: float, redraw: float, seed: int) -> np.ndarray:
    """How often a member has each row: drawn with mean `share`, then each draw drawn again with mean `redraw`."""
    k = keys.astype(np.int64).view(np.uint64)
    first = poisson(unit(seed, 11, member, k), share)
    return first + poisson(unit(seed, 12, member, k), first * redraw)


@dataclass(frozen=True)
class Task:
    """One fit: a member's rows and columns, a penalty, and the fold it leaves out (-1: none)."""

    member: int
    cols: tuple[int, ...]
    C: float
    fold: int = -1


def folds_of(keys: np.ndarray, folds: int, seed: int) -> np.ndarray:
    return (unit(seed, 13, keys.astype(np.int64).view(np.uint64)) * folds).astype(np.int64)


def _design(x: np.ndarray, cols: Sequence[int], mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    c = list(cols)
    return np.column_stack([(x[:, c] - mean[c]) / scale[c], np.ones(len(x))])


def solve_all(data: DataFrame, tasks: Sequence[Task], mean: np.ndarray, scale: np.ndarray, weights: Mapping[int, float], share: float, redraw: float, folds: int, seed: int, steps: int = 40, tol: float = 1e-9) -> np.ndarray:
    """Coefficients of every task on scaled columns, then its intercept, padded with zeros. `data` holds h, x and y (0 or 1).

    Minimises |w|^2 / 2 + C * sum of weighted log losses, w by the columns as they came; the intercept is free. A
    step that does not lessen the loss is halved. One read a step for all.
    """
    width = max(len(t.cols) for t in tasks) + 1
    at = np.zeros((len(tasks), width))
    good, loss, move = at.copy(), np.full(len(tasks), np.inf), np.zeros_like(at)
    open_ = np.ones(len(tasks), bool)
    penalty = [np.append(1 / scale[list(t.cols)] ** 2, 0.0) for t in tasks]
    buckets = max(1, math.isqrt(data.rdd.getNumPartitions()))
    for _ in range(steps):

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict = {}
            for b in batches:
                if not b.num_rows:
                    continue
                h, x, y = b.column(0).to_numpy(), _rows(b.column(1)), b.column(2).to_numpy()
                part = folds_of(h, folds, seed)
                cost = np.where(y == 1, weights.get(1, 1.0), weights.get(0, 1.0))
                drawn = {m: draws(h, m, share, redraw, seed) for m in {t.member for t, o in zip(tasks, open_) if o}}
                for i in np.flatnonzero(open_):
                    t = tasks[i]
                    w = cost * drawn[t.member] * (part != t.fold)
                    rows = np.flatnonzero(w)
                    z = _design(x[rows], t.cols, mean, scale)
                    s = z @ at[i, : z.shape[1]]
                    p = 1 / (1 + np.exp(-s))
                    w = w[rows]
                    out = np.concatenate([[w @ (np.logaddexp(0, s) - y[rows] * s)], z.T @ (w * (p - y[rows])), (z.T @ (z * (w * p * (1 - p))[:, None])).ravel()])
                    total[i] = total.get(i, 0) + out
            k = list(total)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array([0] * len(k), pa.int32()), pa.array([_task()] * len(k), pa.int32()), pa.array([total[i].tobytes() for i in k], pa.binary())], names=["tree", "node", "part", "blob"])

        for r in _sum_blobs(data.mapInArrow(sums, "tree int, node int, part int, blob binary"), buckets, np.float64).collect():  # a row a task
            i, got = r["tree"], np.frombuffer(r["blob"], np.float64)
            k, C = len(tasks[i].cols) + 1, tasks[i].C
            w = at[i, :k]
            now = C * got[0] + (penalty[i] * w * w).sum() / 2
            if now > loss[i] + 1e-12 * abs(loss[i]):  # too far: half the step from the last good place
                move[i] /= 2
                at[i] = good[i] + move[i]
                open_[i] = np.abs(move[i]).max() > tol
                continue
            grad = C * got[1: 1 + k] + penalty[i] * w
            hess = C * got[1 + k:].reshape(k, k) + np.diag(penalty[i])
            good[i], loss[i] = at[i], now
            move[i, :k] = -np.linalg.lstsq(hess, grad, rcond=None)[0]
            open_[i] = np.abs(move[i]).max() > tol * (1 + np.abs(w).max())
            if open_[i]:
                at[i] = good[i] + move[i]
        if not open_.any():
            break
    return good


@dataclass
class Committee:
    columns: list[tuple[int, ...]]
    coefficients: np.ndarray  # by member, on scaled columns, the intercept after them
    mean: np.ndarray
    scale: np.ndarray
    C: float
    scores: list[tuple[float, float]]  # (C, mean accuracy over the folds)
    feats: str | list
    meta: Forest | None = None

    def votes(self, df: DataFrame, out: str = "votes") -> DataFrame:
        """`df` with every member's class, 0 or 1, as an array of doubles."""

        @F.arrow_udf("array<double>")
        def vote(col: pa.Array) -> pa.Array:
            x, n = _rows(col), len(self.columns)
            v = [_design(x, c, self.mean, self.scale) @ w[: len(c) + 1] > 0 for c, w in zip(self.columns, self.coefficients)] if len(x) else []
            flat = np.stack(v, 1).astype(np.float64).ravel() if len(x) else np.empty(0)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(col) + 1) * (n if len(x) else 0), pa.int32()), pa.array(flat))

        return df.withColumn(out, vote(_vec(df, self.feats)))

    def transform(self, df: DataFrame) -> DataFrame:
        if self.meta is None:
            raise ValueError("the committee has no model over its votes")
        return self.meta.transform(self.votes(df, "_votes")).drop("_votes")


def fit_committee(
    df: DataFrame, key: str, feats, label: str, holdout: DataFrame, n: int = 30, rows: int = 8166, redraw: int = 5444, col_share: float = 0.64,
    C_grid: Sequence[float] = C_GRID, weights: Mapping[int, float] | None = None, folds: int = 5, trees: int = 100, seed: int = 42,
) -> Committee:
    """`n` members, each on about `rows` drawn rows, `redraw` of them drawn again, and a draw of the columns. C is the
    one of best mean accuracy over `folds` folds of the last member's rows (the smaller of equals); extremely
    randomized trees learn from the members' votes over `holdout`. Labels are 0 or 1; feature columns a list of names.
    """
    weights = weights or {0: 0.1, 1: 0.9}
    src = df.select(F.xxhash64(F.col(key)).alias("h"), _vec(df, feats).alias("x"), F.col(label).cast("int").alias("y")).where("y is not null")
    data = settle(src)
    names = list(feats)
    stats = data.select(*[F.col("x")[i].alias(f"x{i}") for i in range(len(names))])
    told = stats.agg(F.count("*").alias("n"), *[f(f"x{i}").alias(f"{t}{i}") for i in range(len(names)) for t, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not told["n"]:
        raise ValueError("no rows to learn from")
    mean, scale = (np.array([told[f"{t}{i}"] for i in range(len(names))], np.float64) for t in ("m", "s"))
    scale = np.where(scale > 0, scale, 1.0)
    share, again = rows / told["n"], redraw / rows
    cols = [tuple(sorted(names.index(c) for c in bootstrap_columns(names, col_share, seed + i))) for i in range(n)]
    search = [Task(n - 1, cols[-1], float(C), f) for C in C_grid for f in range(folds)]
    found = solve_all(data, search, mean, scale, weights, share, again, folds, seed)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(len(search)), np.zeros(len(search))
        for b in batches:
            if not b.num_rows:
                continue
            h, x, y = b.column(0).to_numpy(), _rows(b.column(1)), b.column(2).to_numpy()
            part, drawn, z = folds_of(h, folds, seed), draws(h, n - 1, share, again, seed), _design(x, cols[-1], mean, scale)
            for i, t in enumerate(search):
                w = drawn * (part == t.fold)
                right[i] += w @ ((z @ found[i, : z.shape[1]] > 0) == y)
                seen[i] += w.sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(search)), pa.int32()), pa.array(right), pa.array(seen)], names=["i", "hit", "rows"])

    hits = {r["i"]: r["hit"] / r["rows"] if r["rows"] else 0.0 for r in data.mapInArrow(score, "i int, hit double, rows double").groupBy("i").agg(F.sum("hit").alias("hit"), F.sum("rows").alias("rows")).collect()}
    scores = [(float(C), sum(hits[j * folds + f] for f in range(folds)) / folds) for j, C in enumerate(C_grid)]
    C = max(scores, key=lambda s: (round(s[1], 12), -s[0]))[0]
    coefficients = solve_all(data, [Task(i, c, C) for i, c in enumerate(cols)], mean, scale, weights, share, again, folds, seed)
    out = Committee(cols, coefficients, mean, scale, C, scores, feats)
    out.meta = fit_extra_trees(out.votes(holdout, "_votes").select(key, "_votes", label), key, "_votes", label, trees, seed=seed)
    return out
