"""Learning with few labels: self-training and label spreading."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from larkspur.operators.neighbors import nearest
from larkspur.session import settle


def self_train(
    fit: Callable[[DataFrame], object], labelled: DataFrame, unlabelled: DataFrame, label: str, threshold: float = 0.95, rounds: int = 10
):
    """(model, training rows): fit, add the rows predicted with a probability of at least the threshold
    under their predicted label, refit; stops when no row is added, and warns if `rounds` ends it before."""
    train, open_rows = labelled, unlabelled
    model = fit(train)
    for _ in range(rounds):
        scored = model.transform(open_rows).withColumn("_top", F.array_max(vector_to_array("probability")))
        scored = settle(scored.select(*open_rows.columns, F.col("prediction").cast(labelled.schema[label].dataType).alias("_new"), "_top"))
        sure = F.col("_top") >= threshold
        added = scored.where(sure).withColumn(label, F.col("_new")).select(*labelled.columns)
        if added.isEmpty():
            break
        train = settle(train.unionByName(added))
        open_rows = scored.where(~sure).select(*open_rows.columns)
        model = fit(train)
    else:
        warnings.warn(f"self-training still added rows in round {rounds}", stacklevel=2)
    return model, train


def spread_labels(
    df: DataFrame, key: str, feats, label: str, k: int = 7, alpha: float = 0.2, gamma: float = 20.0, rounds: int = 30, tol: float = 1e-3
) -> DataFrame:
    """(key, prediction, score): labels flow along the k-nearest-neighbour graph with weights
    exp(-gamma d^2), F <- alpha S F + (1 - alpha) Y. Null labels are the open ones. The graph holds
    k edges per row instead of all n x n weights; each round is a join and a sum, then a checkpoint.
    Warns if `rounds` ends it before the labels move by less than `tol` in all."""
    classes = sorted(r[0] for r in df.where(F.col(label).isNotNull()).select(label).distinct().collect())
    near = nearest(df, df, key, feats, k, exclude_self=True)
    half = near.select(F.col(key).alias("a"), F.col("neighbor").alias("b"), F.exp(-gamma * F.col("distance") * F.col("distance")).alias("w"))
    edges = settle(half.union(half.select("b", "a", "w")).groupBy("a", "b").agg(F.max("w").alias("w")))
    degree = edges.groupBy("a").agg(F.sum("w").alias("deg"))
    edges = edges.join(degree, "a").join(degree.select(F.col("a").alias("b"), F.col("deg").alias("deg_b")), "b")
    edges = settle(edges.select("a", "b", (F.col("w") / F.sqrt(F.col("deg") * F.col("deg_b"))).alias("s")))
    names = [f"f{i}" for i in range(len(classes))]
    start = df.select(
        F.col(key).alias("a"), *[F.when(F.col(label) == F.lit(c), 1.0).otherwise(0.0).alias(f"y{i}") for i, c in enumerate(classes)]
    )
    start = settle(start)
    cur = start.select("a", *[F.col(f"y{i}").alias(n) for i, n in enumerate(names)])
    for _ in range(rounds):
        flow = edges.join(cur.withColumnRenamed("a", "b"), "b").groupBy("a").agg(*[F.sum(F.col("s") * F.col(n)).alias(f"g_{n}") for n in names])
        joined = start.join(flow, "a", "left").join(cur, "a")
        new = [(alpha * F.coalesce(F.col(f"g_{n}"), F.lit(0.0)) + (1 - alpha) * F.col(f"y{i}")).alias(f"n_{n}") for i, n in enumerate(names)]
        step = settle(joined.select("a", *names, *new))
        moved = step.agg(F.sum(sum((F.abs(F.col(f"n_{n}") - F.col(n)) for n in names), F.lit(0.0)))).first()[0]
        cur = step.select("a", *[F.col(f"n_{n}").alias(n) for n in names])
        if moved is None or moved < tol:
            break
    else:
        warnings.warn(f"labels still moved by {moved} in round {rounds}", stacklevel=2)
    total = sum((F.col(n) for n in names), F.lit(0.0))
    top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    pick = F
    for n, c in zip(names, classes):
        pick = pick.when(F.col(n) == top, F.lit(c))
    share = F.when(total > 0, top / F.nullif(total, F.lit(0.0)))
    return cur.select(F.col("a").alias(key), F.when(total > 0, pick).alias("prediction"), share.alias("score"))
