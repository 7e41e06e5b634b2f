"""Clustering: k-means, top-down splitting, density clusters, and sweeps over their parameters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from larkspur.models.forest import least_forest, levels, neighbour_counts, settled, spanning
from larkspur.models.linear import with_features
from larkspur.operators import evaluate
from larkspur.operators.neighbors import BLOCK, ZONE, Cells, _blocks, _compare, build_cells, points, within
from larkspur.operators.ordered import position
from larkspur.session import settle


def as_vectors(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """An array column as an ml vector."""
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


def fit_kmeans(df: DataFrame, feats, k: int, seed: int = 42, out: str = "cluster") -> PipelineModel:
    return with_features(feats, KMeans(k=k, seed=seed, predictionCol=out)).fit(df)


def fit_hierarchical(df: DataFrame, feats, k: int, seed: int = 42, out: str = "cluster") -> PipelineModel:
    """Bisecting k-means: a top-down hierarchy, not the bottom-up linkage, which needs all n x n distances."""
    return with_features(feats, BisectingKMeans(k=k, seed=seed, predictionCol=out)).fit(df)


def add_cluster_feature(df: DataFrame, model: PipelineModel, feats: str, cluster: str = "cluster", out: str = "features_with_cluster") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=[feats, cluster], outputCol=out).transform(model.transform(df))


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node of each connected component, from edges (a, b).

    Two star steps alternate: hang larger neighbours on the smallest neighbour, then smaller ones. The
    graph shrinks to stars in about log rounds, whatever its diameter; hot nodes only ever take a minimum,
    which combines before the shuffle. Each round is checkpointed.
    """
    cur = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = cur.union(cur.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        cur = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = cur.groupBy("a").agg(F.min("b").alias("m"))
        hung = cur.join(low, "a")
        cur = hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        cur = settle(cur.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
        mark = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
    raise RuntimeError("components did not settle")


def _within(pts: DataFrame, others: DataFrame, cells: Cells, eps: float, fn, schema: str, merge=None, half: bool = False) -> DataFrame:
    left, right = _blocks(pts, others, cells, lambda d, _: np.full(len(d), eps), BLOCK, half)
    return _compare(left, right, fn, schema, BLOCK, merge)


def dbscan(df: DataFrame, key: str, feats, eps: float, m: int, out: str = "cluster") -> DataFrame:
    """(key, cluster): density clusters, noise = -1, clusters numbered by their smallest core key.

    Equal points are one point with a weight. Rows meet block by block (see neighbors): one pass counts neighbours, each
    pair once. Some core points then tell which others hang together anyway (see forest); for the rest one pass returns
    per block pair a spanning forest of the core points in reach of each other (at most one edge per point), and one finds
    for the points that are not core the smallest component in reach.
    """
    pts = points(df, key, feats)
    reps = settle(pts.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight")))
    id_type = reps.schema["id"].dataType.simpleString()
    placed, cells = build_cells(reps, 0)
    one = np.array([eps], np.float64)

    def count(a: pd.DataFrame, b: pd.DataFrame, x: np.ndarray, y: np.ndarray, both: bool) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "n": []})
        of_a, of_b = neighbour_counts(x, y, a["weight"].to_numpy(), b["weight"].to_numpy(), one, both)
        t = pd.DataFrame({"id": a["id"].to_numpy(), "n": of_a[:, 0]})
        return pd.concat([t, pd.DataFrame({"id": b["id"].to_numpy(), "n": of_b[:, 0]})]) if both else t

    rows = placed.select("id", "v", "weight", "cell")
    counts = _within(rows, rows, cells, eps, count, f"id {id_type}, n bigint", lambda t: t.groupby("id", as_index=False)["n"].sum(), True)
    dense = settle(counts.groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") >= m).select("id"))
    core = settle(placed.join(dense, "id"))
    since, first = settled(core.select("id", "v", F.array(F.lit(0)).alias("core")), one, 1, BLOCK, BLOCK * ZONE)
    whole = settle(core.select("id", "v", "cell").join(since.select("id", F.col("since")[0].alias("since")), "id"))

    def forest(a: pd.DataFrame, b: pd.DataFrame, x: np.ndarray, y: np.ndarray, _: bool) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": []})
        i, j, _ = least_forest(levels(x, y, one), 1, (a["since"].to_numpy(np.int8), b["since"].to_numpy(np.int8)))
        return pd.DataFrame({"a": a["id"].to_numpy()[i], "b": b["id"].to_numpy()[j]})

    def thin(t: pd.DataFrame) -> pd.DataFrame:
        return t.iloc[spanning(t["a"].to_numpy(), t["b"].to_numpy(), np.zeros(len(t), np.int64))]

    apart = whole.where("since > 0").select("id", "v", "since")
    edges = _within(apart, whole, cells.holding(whole), eps, forest, f"a {id_type}, b {id_type}", thin)
    if first[0] is not None:
        edges = edges.union(whole.where("since = 0").select(F.col("id").alias("a"), F.lit(first[0]).cast(id_type).alias("b")))
    roots = components(edges)
    core_root = core.select("id", "v", "cell", "dist").join(roots.withColumnRenamed("node", "id"), "id", "left")
    core_root = settle(core_root.withColumn("root", F.coalesce("root", "id")))
    rest = reps.select("id", "v").join(dense, "id", "left_anti")

    def reach(a: pd.DataFrame, b: pd.DataFrame, x: np.ndarray, y: np.ndarray, _: bool) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "root": []})
        order = np.argsort(b["root"].to_numpy(), kind="stable")
        hit = within(x, y[order], eps)
        any_hit = hit.any(1)
        return pd.DataFrame({"id": a["id"].to_numpy()[any_hit], "root": b["root"].to_numpy()[order][hit.argmax(1)][any_hit]})

    smallest = lambda t: t.groupby("id", as_index=False)["root"].min()
    border = _within(rest, core_root, cells.holding(core_root), eps, reach, f"id {id_type}, root {id_type}", smallest).groupBy("id").agg(F.min("root").alias("root"))
    found = settle(core_root.select("id", "root").union(border.select("id", "root")))
    numbers = position(found.select("root").distinct(), "root", out)
    labelled = found.join(numbers, "root").select("id", out)
    by_value = reps.select("v", "id").join(labelled, "id", "left").select("v", F.coalesce(F.col(out), F.lit(-1)).alias(out))
    return pts.join(by_value, "v").select(F.col("id").alias(key), F.col(out).cast("bigint").alias(out))


def sweep_k(df: DataFrame, feats: str, ks: Sequence[int], seed: int = 42) -> DataFrame:
    """(k, silhouette, inertia, best), one row per k; the highest silhouette is best, the smaller k among equals.
    The table is read once into memory for all fits."""
    df = df.cache()
    out = None
    for k in ks:
        model = fit_kmeans(df, feats, k, seed)
        scored = model.transform(df)
        row = evaluate.silhouette(scored, feats, "cluster").select(
            F.lit(k).alias("k"), "silhouette", F.lit(float(model.stages[-1].summary.trainingCost)).alias("inertia")
        )
        out = row if out is None else out.unionByName(row)
    top = out.agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("_k"))
    return out.join(top, F.col("k") == F.col("_k"), "left").withColumn("best", F.col("_k").isNotNull()).drop("_k")
