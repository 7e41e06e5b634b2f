"""Forests whose draws are hashes: extremely randomized trees, and bootstrap forests that know which rows each tree saw.

All trees grow together, level by level. A node's candidate features are those of least hash of (seed, tree, node,
feature); its cut points lie between the node's own least and greatest value, at a hashed place (one cut: extremely
randomized trees) or evenly (several cuts: a forest on histograms). A level takes two reads of the rows: one for the
ranges of (tree, node, feature), one for counts by (tree, node, feature, cut, class). Tasks add up their rows in
numpy and send one array per node that they hold; arrays are added in two steps, so no task meets one from every
other. What reaches the driver is one row per node, never more than trees * 2^depth.

In a bootstrap a row's weight in a tree is a Poisson number drawn from the hash of its key and the tree. So any
later read knows the trees that did not see a row, and the out-of-bag error of every prefix of the forest is one
read. A task that runs again draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larkspur.operators.neighbors import _vec
from larkspur.session import settle

POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def mix(*parts) -> np.ndarray:
    """A 64-bit hash of numbers that broadcast against each other."""
    with np.errstate(over="ignore"):
        out = np.uint64(0x9E3779B97F4A7C15)
        for p in parts:
            out = (out ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            out = out ^ (out >> np.uint64(32))
    return out


def unit(*parts) -> np.ndarray:
    """The same as a number in [0, 1)."""
    return (mix(*parts) >> np.uint64(11)).astype(np.float64) / 2.0**53


def row_weights(keys: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """How often each tree draws each row: Poisson numbers of mean one."""
    return np.searchsorted(POISSON, unit(seed, 1, keys.astype(np.int64).view(np.uint64)[:, None], np.arange(trees)[None, :]), "right")


def node_features(seed: int, tree: int, nodes: np.ndarray, width: int, take: int) -> np.ndarray:
    """The `take` features of least hash for each node, ascending."""
    return np.sort(np.argsort(mix(seed, 2, tree, nodes[:, None], np.arange(width)[None, :]), axis=1, kind="stable")[:, :take], axis=1)


def cut_places(seed: int, tree: int, node: int, feats: np.ndarray, cuts: int) -> np.ndarray:
    """Where between a node's least and greatest value its cuts lie, by feature and cut."""
    if cuts == 1:
        return unit(seed, 3, tree, node, feats)[:, None]
    return np.broadcast_to(np.arange(1, cuts + 1) / (cuts + 1), (len(feats), cuts))


def best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """(feature, cut) of the greatest loss of Gini impurity over counts by feature, bin and class; the first of equals.
    None if nothing is gained."""
    left = counts.cumsum(1)[:, :-1].astype(np.float64)
    total = counts.sum(1)[:, None].astype(np.float64)
    right, n = total - left, total.sum(2)
    nl, nr = left.sum(2), right.sum(2)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where((nl > 0) & (nr > 0), (left**2).sum(2) / nl + (right**2).sum(2) / nr - (total**2).sum(2) / n, -1.0)
    if not score.size or score.max() <= 1e-9 * max(1.0, float(n.max())):
        return None
    return tuple(int(i) for i in np.unravel_index(int(np.argmax(np.round(score, 9))), score.shape))  # type: ignore[return-value]


@dataclass
class Forest:
    """Trees as arrays by (tree, node); the children of node i are 2i + 1 and 2i + 2."""

    classes: list
    feature: np.ndarray  # -1: a leaf, or a node not grown
    threshold: np.ndarray
    counts: np.ndarray  # (tree, node, class): the rows that reached the node, by weight
    depth: int
    seed: int
    bootstrap: bool
    feats: str | list = "features"

    def at(self, x: np.ndarray) -> np.ndarray:
        """(row, tree): the node where each row ends."""
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[trees, node]
            down = 2 * node + 1 + (x[rows, np.maximum(f, 0)] > self.threshold[trees, node])
            node = np.where(f >= 0, down, node)
        return node

    def votes(self, x: np.ndarray) -> np.ndarray:
        """(row, tree, class): the class shares of each row's leaf."""
        c = self.counts[np.arange(len(self.feature))[None, :], self.at(x)].astype(np.float64)
        return c / np.maximum(c.sum(2, keepdims=True), 1)

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with the class of the greatest mean share, the first of equals."""
        classes = np.array(self.classes, dtype=np.float64)

        @F.arrow_udf("double")
        def predict(col: pa.Array) -> pa.Array:
            x = _rows(col)
            return pa.array(classes[self.votes(x).mean(1).argmax(1)] if len(x) else np.empty(0))

        return df.withColumn("prediction", predict(_vec(df, self.feats)))


def _rows(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1) if len(col) else np.empty((0, 0))


def _sum_blobs(parts: DataFrame, buckets: int, kind: type = np.int64) -> DataFrame:
    """(tree, node, blob): the sums of arrays of eight-byte numbers, in two steps."""

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, kind) for b in t["blob"].to_pylist())
        return pa.table({"tree": t["tree"].slice(0, 1), "node": t["node"].slice(0, 1), "blob": pa.array([total.tobytes()], pa.binary())})

    some = parts.groupBy("tree", "node", F.pmod(F.col("part"), F.lit(buckets)).alias("bucket")).applyInArrow(add, "tree int, node int, blob binary")
    return some.groupBy("tree", "node").applyInArrow(add, "tree int, node int, blob binary") if buckets > 1 else some


def fit_trees(
    df: DataFrame, key: str, feats, label: str, trees: int = 100, depth: int = 5, take: int | str = "sqrt", cuts: int = 1,
    bootstrap: bool = False, seed: int = 42,
) -> Forest:
    """Grow a forest on rows with a unique key, features without nulls and a label. `take` is a number of features or
    sqrt, log2 or all. A node with one class, or where no cut gains, is a leaf."""
    src = df.select(F.xxhash64(F.col(key)).alias("h"), _vec(df, feats).alias("x"), F.col(label).cast("double").alias("y")).where("y is not null")
    classes = [r[0] for r in src.select("y").distinct().orderBy("y").collect()]  # one number a class, as each leaf holds
    data = settle(src.withColumn("y", (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("y")) - 1).cast("int")))
    first = data.select(F.size("x")).first()
    if first is None:
        raise ValueError("no rows to learn from")
    width, many = first[0], len(classes)
    k = {"sqrt": max(1, math.isqrt(width)), "log2": max(1, int(math.log2(width))), "all": width}[take] if isinstance(take, str) else take
    nodes = 2 ** (depth + 1) - 1
    model = Forest(classes, np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes, many), np.int64), depth, seed, bootstrap, feats)
    buckets = max(1, math.isqrt(data.rdd.getNumPartitions()))
    # open nodes: those of the level that may split
    open_ = {t: np.array([0]) for t in range(trees)}

    def reads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(tree, node, rows of x, classes, weights) for every batch and open node."""
        for b in batches:
            if not b.num_rows:
                continue
            x, y = _rows(b.column(1)), b.column(2).to_numpy()
            at = model.at(x)
            w = row_weights(b.column(0).to_numpy(), trees, seed) if bootstrap else None
            for t, own in open_.items():
                for node in own.tolist():
                    rows = np.flatnonzero((at[:, t] == node) & (w[:, t] > 0)) if bootstrap else np.flatnonzero(at[:, t] == node)
                    if len(rows):
                        yield t, node, x[rows], y[rows], w[rows, t] if bootstrap else np.ones(len(rows), np.int64)

    for level in range(depth):
        fs = {(t, n): f for t, own in open_.items() for n, f in zip(own.tolist(), node_features(seed, t, own, width, k))}

        def ranges(batches):
            low, high = {}, {}
            for t, node, x, _, _ in reads(batches):
                x = x[:, fs[t, node]]
                low[t, node] = np.minimum(low.get((t, node), np.inf), x.min(0))
                high[t, node] = np.maximum(high.get((t, node), -np.inf), x.max(0))
            rows = [(t, n, f, lo, hi) for (t, n), a in low.items() for f, lo, hi in zip(fs[t, n].tolist(), a.tolist(), high[t, n].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [[]] * 5, [pa.int32()] * 3 + [pa.float64()] * 2)], names=["tree", "node", "f", "lo", "hi"])

        found = data.mapInArrow(ranges, "tree int, node int, f int, lo double, hi double").groupBy("tree", "node", "f").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        span = found.groupBy("tree", "node").agg(F.sort_array(F.collect_list(F.struct("f", "lo", "hi"))).alias("s")).collect()  # a row for each open node
        place = {}
        for r in span:
            lo, hi = (np.array([s[c] for s in r["s"]]) for c in ("lo", "hi"))
            u = cut_places(seed, r["tree"], r["node"], fs[r["tree"], r["node"]], cuts)
            place[r["tree"], r["node"]] = lo[:, None] + u * (hi - lo)[:, None]

        def tally(batches):
            total: dict = {}
            for t, node, x, y, w in reads(batches):
                b = (x[:, fs[t, node]][:, :, None] > place[t, node][None]).sum(2)
                flat = (np.arange(k)[None, :] * (cuts + 1) + b) * many + y[:, None]
                total[t, node] = total.get((t, node), 0) + np.bincount(flat.ravel(), np.repeat(w, k), k * (cuts + 1) * many).astype(np.int64)
            part = pa.array([_task()] * len(total), pa.int32())
            t, n = zip(*total) if total else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(n, pa.int32()), part, pa.array([a.tobytes() for a in total.values()], pa.binary())], names=["tree", "node", "part", "blob"])

        def choose(t: pa.Table) -> pa.Table:
            out: list[list] = [[] for _ in range(5)]
            for tree, node, blob in zip(*(t[c].to_pylist() for c in ("tree", "node", "blob"))):
                counts = np.frombuffer(blob, np.int64).reshape(k, cuts + 1, many)
                best = best_split(counts)
                f, c = best or (0, 0)
                left = counts[f, : c + 1].sum(0)
                for column, value in zip(out, (tree, node, -1 if best is None else f * cuts + c, left.tolist(), (counts[f].sum(0) - left).tolist())):
                    column.append(value)
            return pa.table([pa.array(c, kind) for c, kind in zip(out, [pa.int32()] * 3 + [pa.list_(pa.int64())] * 2)], names=["tree", "node", "best", "l", "r"])

        summed = _sum_blobs(data.mapInArrow(tally, "tree int, node int, part int, blob binary"), buckets)
        grown = summed.groupBy("tree").applyInArrow(choose, "tree int, node int, best int, l array<bigint>, r array<bigint>").collect()  # a row for each open node
        later: dict = {}
        for r in sorted(grown, key=lambda r: (r["tree"], r["node"])):
            t, n = r["tree"], r["node"]
            left, right = np.array(r["l"]), np.array(r["r"])
            model.counts[t, n] = left + right
            if r["best"] < 0:
                continue
            f, c = divmod(r["best"], cuts)
            model.feature[t, n], model.threshold[t, n] = fs[t, n][f], place[t, n][f, c]
            for child, own in ((2 * n + 1, left), (2 * n + 2, right)):
                model.counts[t, child] = own
                if level + 1 < depth and np.count_nonzero(own) > 1:
                    later.setdefault(t, []).append(child)
        open_ = {t: np.array(n) for t, n in later.items()}
        if not open_:
            break
    return model


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def fit_extra_trees(df: DataFrame, key: str, feats, label: str, trees: int = 100, depth: int = 5, take: int | str = "sqrt", seed: int = 42) -> Forest:
    """Extremely randomized trees: no bootstrap, one random cut for each candidate feature of a node."""
    return fit_trees(df, key, feats, label, trees, depth, take, 1, False, seed)


def out_of_bag(model: Forest, df: DataFrame, key: str, label: str, sizes: Sequence[int]) -> DataFrame:
    """(trees, error, rows): for each prefix of a bootstrap forest the share of wrong rows, each judged by the trees of
    the prefix that did not see it; rows that all of them saw are left out."""
    if not model.bootstrap:
        raise ValueError("without a bootstrap every tree saw every row")
    want, classes = sorted(set(sizes)), np.array(model.classes)
    if not want or want[0] < 1 or want[-1] > len(model.feature):
        raise ValueError("sizes run from 1 to the trees of the forest")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        miss, rows = np.zeros(len(want), np.int64), np.zeros(len(want), np.int64)
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                x, y = _rows(part.column(1)), part.column(2).to_numpy()
                free = row_weights(part.column(0).to_numpy(), len(model.feature), model.seed) == 0
                votes = np.cumsum(model.votes(x) * free[:, :, None], axis=1)[:, np.array(want) - 1]
                seen = np.cumsum(free, axis=1)[:, np.array(want) - 1] > 0
                wrong = classes[votes.argmax(2)] != y[:, None]
                miss += (wrong & seen).sum(0)
                rows += seen.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(want, pa.int32()), pa.array(miss), pa.array(rows)], names=["trees", "miss", "rows"])

    src = df.select(F.xxhash64(F.col(key)).alias("h"), _vec(df, model.feats).alias("x"), F.col(label).cast("double").alias("y")).where("y is not null")
    sums = src.mapInArrow(judge, "trees int, miss long, rows long").groupBy("trees").agg(F.sum("miss").alias("miss"), F.sum("rows").alias("rows"))
    return sums.select("trees", (F.col("miss") / F.nullif(F.col("rows"), F.lit(0))).alias("error"), "rows")


def sweep_forest(df: DataFrame, key: str, feats, label: str, sizes: Sequence[int], strategies: Sequence[str], depth: int = 5, cuts: int = 8, seed: int = 42) -> DataFrame:
    """(strategy, trees, error, rows) by out-of-bag error: one forest of the largest size for each strategy, whose
    first trees are the smaller ones."""
    out = None
    for s in strategies:
        model = fit_trees(df, key, feats, label, max(sizes), depth, s, cuts, True, seed)
        part = out_of_bag(model, df, key, label, sizes).select(F.lit(s).alias("strategy"), "trees", "error", "rows")
        out = part if out is None else out.unionByName(part)
    return out
