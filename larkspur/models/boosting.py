"""Gradient boosted trees for several classes as one model: every round grows one tree a class on shared softmax gradients.

A row's gradients need all its scores, so the classes of a round cannot be fitted apart. Each level of a round is
one read: tasks work out the gradients of their rows, add them up by (class, node, feature, bin) in numpy and send
one array for each class and node; the arrays are added and split in the same shuffle. Scores lie in the rows and
are written back every few rounds, so that a read follows only the trees grown since. A row holds its features as bin
numbers, found once: a value is above a cut just if its bin is. The driver holds the trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.models.trees import _rows
from larkspur.operators.neighbors import _vec
from larkspur.session import settle

START = 0.5
NOTHING = 0xFFFF


@dataclass
class Round:
    """One tree a class as arrays by (class, node); the children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray  # -1: a leaf, or a node not grown
    threshold: np.ndarray
    value: np.ndarray
    cut: np.ndarray  # place of the threshold among the feature's cut points

    def at(self, x: np.ndarray, depth: int, binned: bool = False) -> np.ndarray:
        """(row, class): the node that each row, of values or of bins, has come to after `depth` levels."""
        limit = self.cut if binned else self.threshold
        trees = np.arange(len(self.feature))[None, :]
        node, rows = np.zeros((len(x), len(self.feature)), np.int64), np.arange(len(x))[:, None]
        for _ in range(depth):
            f = self.feature[trees, node]
            node = np.where(f >= 0, 2 * node + 1 + (x[rows, np.maximum(f, 0)] > limit[trees, node]), node)
        return node

    def scores(self, x: np.ndarray, depth: int, binned: bool = False) -> np.ndarray:
        return self.value[np.arange(len(self.feature))[None, :], self.at(x, depth, binned)]


@dataclass
class Boosted:
    classes: list
    depth: int
    feats: str | list
    rounds: list[Round] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full((len(x), len(self.classes)), START)
        for r in self.rounds:
            out += r.scores(x, self.depth)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with class probabilities and the likeliest class, the first of equals."""
        classes = np.array(self.classes, dtype=np.float64)

        @F.arrow_udf("array<double>")
        def probability(col: pa.Array) -> pa.Array:
            x = _rows(col)
            p = softmax(self.scores(x)) if len(x) else np.empty((0, len(classes)))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(classes), pa.int32()), pa.array(p.ravel()))

        out = df.withColumn("probability", probability(_vec(df, self.feats)))
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return out.withColumn("prediction", F.element_at(F.array(*[F.lit(float(c)) for c in classes]), best))


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log loss by each class's score; the second as a bound that also holds the
    other classes' part."""
    p = softmax(s)
    return p - (np.arange(s.shape[1])[None, :] == y[:, None]), 2 * p * (1 - p)


def best_cut(g: np.ndarray, h: np.ndarray, penalty: float, least: float) -> tuple[int, int] | None:
    """(feature, bin) of the greatest gain over sums by feature and bin, the first of equals; None if nothing is gained."""
    gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
    gt, ht = g.sum(1)[:, None], h.sum(1)[:, None]
    gr, hr = gt - gl, ht - hl
    gain = np.where((hl >= least) & (hr >= least), gl**2 / (hl + penalty) + gr**2 / (hr + penalty) - gt**2 / (ht + penalty), -1.0)
    gain = np.round(gain, 9)
    return tuple(int(i) for i in np.unravel_index(int(gain.argmax()), gain.shape)) if gain.size and gain.max() > 0 else None  # type: ignore[return-value]


def cut_points(df: DataFrame, bins: int) -> np.ndarray:
    """(feature, bins - 1) cut points at even ranks, by mergeable summaries of the columns."""
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = df.select(F.posexplode("x").alias("f", "v")).groupBy("f").agg(F.percentile_approx("v", probs, 10_000).alias("c")).orderBy("f").collect()  # a row a feature
    return np.array([r["c"] for r in found], dtype=np.float64)


def _binned(data: DataFrame, cuts: np.ndarray) -> DataFrame:
    """`data` with the features' bins as 16-bit numbers in place of their values; NOTHING stands for a NaN."""

    @F.arrow_udf("binary")
    def bins(col: pa.Array) -> pa.Array:
        x = _rows(col)
        if not len(x):
            return pa.array([], pa.binary())
        out = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(len(cuts))], 1).astype("<u2")
        out[np.isnan(x)] = NOTHING
        return pa.array([r.tobytes() for r in out], pa.binary())

    return data.select(bins("x").alias("x"), "y", "s")


def _bins(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins that a cut is compared with, bins that sums go to): a NaN is above no cut and in the last bin's sum."""
    x = np.frombuffer(b"".join(col.to_pylist()), "<u2").reshape(-1, width).astype(np.int64)
    return np.where(x == NOTHING, 0, x), x


def fit_boosting(
    df: DataFrame, feats, label: str, rounds: int = 100, depth: int = 3, rate: float = 0.1, bins: int = 32, penalty: float = 1.0,
    least: float = 1.0, cut_every: int = 10,
) -> Boosted:
    """`rounds` times one tree of `depth` levels for each class. `penalty` is added to a node's second derivatives, a child
    holds at least `least` of them; cuts lie at the even ranks of each feature. Rows without a label are left out."""
    src = df.select(_vec(df, feats).alias("x"), F.col(label).cast("double").alias("y")).where("y is not null")
    classes = [r[0] for r in src.select("y").distinct().orderBy("y").collect()]  # one tree a class and round
    if not classes:
        raise ValueError("no rows to learn from")
    many, nodes, model = len(classes), 2 ** (depth + 1) - 1, Boosted(classes, depth, feats)
    index = (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("y")) - 1).cast("int")
    data = settle(src.select("x", index.alias("y"), F.array_repeat(F.lit(START), many).alias("s")))
    cuts = cut_points(data, bins)
    width = len(cuts)
    data = settle(_binned(data, cuts))
    base = np.arange(width)[None, :] * bins

    def now(col: pa.Array, x: np.ndarray, pending: list[Round]) -> np.ndarray:
        s = _rows(col).copy()
        for r in pending:
            s += r.scores(x, depth, binned=True)
        return s

    pending: list[Round] = []
    for _ in range(rounds):
        grown = Round(np.full((many, nodes), -1), np.zeros((many, nodes)), np.zeros((many, nodes)), np.zeros((many, nodes), np.int64))
        sums = {}  # (class, node): sums of both derivatives
        open_ = [(k, 0) for k in range(many)]
        for level in range(depth):

            def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total: dict = {}
                for b in batches:
                    if not b.num_rows:
                        continue
                    (x, bin_), y = _bins(b.column(0), width), b.column(1).to_numpy()
                    g, h = gradients(now(b.column(2), x, pending), y)
                    at = grown.at(x, level, binned=True)
                    bin_ = np.minimum(bin_, bins - 1) + base
                    for k, node in open_:
                        rows = np.flatnonzero(at[:, k] == node)
                        if len(rows):
                            flat = bin_[rows].ravel()
                            part = np.stack([np.bincount(flat, np.repeat(d[rows, k], width), width * bins) for d in (g, h)])
                            total[k, node] = total.get((k, node), 0) + part
                k, node = zip(*total) if total else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(node, pa.int32()), pa.array([a.tobytes() for a in total.values()], pa.binary())], names=["k", "node", "blob"])

            def choose(t: pa.Table) -> pa.Table:
                both = sum(np.frombuffer(b, np.float64) for b in t["blob"].to_pylist()).reshape(2, width, bins)
                best = best_cut(both[0], both[1], penalty, least)
                f, c = best or (0, 0)
                left = both[:, f, : c + 1].sum(1)
                out = [t["k"][0].as_py()], [t["node"][0].as_py()], [-1 if best is None else f * bins + c], [left.tolist()], [(both[:, f].sum(1) - left).tolist()]
                return pa.table([pa.array(c, kind) for c, kind in zip(out, [pa.int32()] * 3 + [pa.list_(pa.float64())] * 2)], names=["k", "node", "best", "l", "r"])

            parts = data.mapInArrow(tally, "k int, node int, blob binary")
            found = parts.groupBy("k", "node").applyInArrow(choose, "k int, node int, best int, l array<double>, r array<double>").collect()  # a row an open node
            open_ = []
            for r in sorted(found, key=lambda r: (r["k"], r["node"])):
                k, node, left, right = r["k"], r["node"], np.array(r["l"]), np.array(r["r"])
                sums[k, node] = left + right
                if r["best"] >= 0:
                    f, c = divmod(r["best"], bins)
                    grown.feature[k, node], grown.threshold[k, node], grown.cut[k, node] = f, cuts[f, c], c
                    for child, own in ((2 * node + 1, left), (2 * node + 2, right)):
                        sums[k, child] = own
                        open_.append((k, child))
            if not open_:
                break
        for (k, node), (g, h) in sums.items():
            grown.value[k, node] = -rate * g / (h + penalty)
        model.rounds.append(grown)
        pending = [*pending, grown]
        if len(pending) == cut_every:
            data, pending = settle(_add_scores(data, pending, depth, width)), []
    return model


def _add_scores(data: DataFrame, pending: list[Round], depth: int, width: int) -> DataFrame:
    @F.arrow_udf("array<double>")
    def add(xs: pa.Array, ss: pa.Array) -> pa.Array:
        (x, _), s = _bins(xs, width), _rows(ss).copy()
        for r in pending:
            s += r.scores(x, depth, binned=True)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(xs) + 1) * (s.shape[1] if len(xs) else 0), pa.int32()), pa.array(s.ravel()))

    moved: Column = add(F.col("x"), F.col("s"))
    return data.select("x", "y", moved.alias("s"))
