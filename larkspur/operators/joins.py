"""Lookup joins, joins by position, unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from larkspur.operators.ordered import position


def attach_lookup(
    df: DataFrame, lookup: DataFrame, key: str, out: Sequence[str], lookup_key: str | None = None
) -> DataFrame:
    """Left join that adds the columns `out`. A lookup with a repeated key would multiply rows, so it is refused.

    No broadcast hint: Spark broadcasts the lookup when its size is under the threshold, and splits a
    hot key of the large side when it is not.
    """
    lookup_key = lookup_key or key
    pairs = lookup.select(F.col(lookup_key).alias("_k"), *out)
    clash = pairs.groupBy("_k").agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"lookup key {lookup_key} repeats, for example {clash[0][0]!r}")
    return df.join(pairs, df[key] == pairs["_k"], "left").drop("_k")


def join_by_position(
    a: DataFrame, b: DataFrame, order_a: str, order_b: str, drop: Sequence[str] = ()
) -> DataFrame:
    """Join the i-th row of `a` to the i-th row of `b`, each in the order of its unique key."""
    return position(a, order_a, "row_id").join(position(b.drop(*drop), order_b, "row_id"), "row_id")


def bind_features(df: DataFrame, blocks: Sequence[DataFrame], key: str, out: str = "features") -> DataFrame:
    """Put numeric columns and vectors of several keyed blocks side by side in one vector."""
    from pyspark.ml.feature import VectorAssembler

    names = [c for c in df.columns if c != key]
    for b in blocks:
        names += [c for c in b.columns if c != key]
        df = df.join(b, key)
    return VectorAssembler(inputCols=names, outputCol=out).transform(df).select(key, out)


def misclassified(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.where(F.col(label) != F.col(prediction))


def union_scores(tables: Mapping[str, DataFrame], tag: str = "model") -> DataFrame:
    """Stack score tables of the same shape, each tagged with its name."""
    out = None
    for name, df in tables.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out
