"""Repeatable splits and class rebalancing.

Every draw is decided by a hash of the row key and a seed, so a lost task draws the same rows again
and the same split can be written as SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from larkspur.operators.ordered import hash_order, hash_rank, null_safe_join, unit_hash

COPY_LOT = 10_000


def split(df: DataFrame, key: str, share: float = 0.8, seed: int = 42, out: str = "part") -> DataFrame:
    """`train` or `test` per row, about `share` train."""
    return df.withColumn(out, F.when(unit_hash(key, seed) < share, F.lit("train")).otherwise(F.lit("test")))


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("_size"))


def _ranked_with_size(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    return hash_rank(df, key, seed, within=[label], out="_rank", size="_size")


def split_stratified(df: DataFrame, key: str, label: str, share: float = 0.8, seed: int = 42, out: str = "part") -> DataFrame:
    """Per class the first round(share * size) rows in hash order are `train`."""
    rows = _ranked_with_size(df, key, label, seed)
    train = F.col("_rank") < F.round(F.col("_size") * share)
    return rows.withColumn(out, F.when(train, F.lit("train")).otherwise(F.lit("test"))).drop("_rank", "_size")


def kfold(df: DataFrame, key: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    return hash_rank(df, key, seed, out=out).withColumn(out, (F.col(out) % k).cast("int"))


def kfold_stratified(df: DataFrame, key: str, label: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    return hash_rank(df, key, seed, within=[label], out=out).withColumn(out, (F.col(out) % k).cast("int"))


def safe_folds(df: DataFrame, label: str, k: int) -> DataFrame:
    """Fold count that leaves a row of the smallest class in every fold."""
    return class_sizes(df, label).agg(F.least(F.lit(k), F.min("_size")).cast("int").alias("folds"))


def sample(df: DataFrame, key: str, frac: float, seed: int = 42) -> DataFrame:
    return df.where(unit_hash(key, seed) < frac)


def oversample(df: DataFrame, key: str, label: str, seed: int = 42, copy: str = "copy") -> DataFrame:
    """Repeat rows of the smaller classes up to the largest class; `copy` numbers the repeats."""
    rows = _ranked_with_size(df, key, label, seed)
    most = class_sizes(df, label).agg(F.max("_size")).scalar()
    times = F.floor(most / F.col("_size")) + (F.col("_rank") < most % F.col("_size")).cast("int")
    # two explodes, so that the one row of a rare class never holds an array of all its copies
    rows = rows.withColumn("_times", times.cast("bigint"))
    rows = rows.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / COPY_LOT))))
    first, last = F.col("_lot") * COPY_LOT + 1, F.least((F.col("_lot") + 1) * COPY_LOT, F.col("_times"))
    return rows.withColumn(copy, F.explode(F.sequence(first, last))).drop("_rank", "_size", "_times", "_lot")


def undersample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Per class the first rows in hash order, as many as the smallest class holds."""
    least = class_sizes(df, label).agg(F.min("_size")).scalar()
    return hash_rank(df, key, seed, within=[label], out="_rank").where(F.col("_rank") < least).drop("_rank")


def bootstrap(df: DataFrame, key: str, n: int, seed: int = 42, redraw: int = 0) -> DataFrame:
    """n rows drawn with replacement, then `redraw` rows drawn again from those n; `draw` numbers them.

    Rows get a dense number by hash order; draw i takes row hash(i) mod N. Draws are counted per row
    before the join, so a draw table of any size meets each row once.
    """
    spark = df.sparkSession
    total = df.agg(F.count("*")).scalar()
    rows = hash_rank(df, key, seed, out="_row")

    def drawn(m: int, salt: str, of) -> DataFrame:
        return spark.range(m).select(F.col("id").alias("draw"), (hash_order("id", f"{seed}{salt}") % of).alias("_row"))

    first = drawn(n, "a", total)
    if redraw:
        again = spark.range(redraw).select(
            (F.col("id") + n).alias("draw"), (hash_order("id", f"{seed}b") % n).alias("_pick")
        )
        # the same arithmetic that gave draw `_pick` its row
        again = again.select("draw", (hash_order("_pick", f"{seed}a") % total).alias("_row"))
        first = first.unionByName(again)
    return first.join(rows, "_row").drop("_row")


def bootstrap_columns(cols: Sequence[str], share: float = 0.64, seed: int = 42) -> list[str]:
    """int(share * p) column draws with replacement, in column order."""
    import hashlib

    take = int(len(cols) * share)
    picks = [int(hashlib.md5(f"{i}|{seed}".encode()).hexdigest()[:8], 16) % len(cols) for i in range(take)]
    return [cols[i] for i in sorted(picks)]


def class_weights(df: DataFrame, label: str, given: Mapping | None = None, out: str = "weight") -> DataFrame:
    """Weight n / (k * n_c) on each row, or the given weight of its class (1 for a class not given). Any number of
    classes; a null label is a class of its own, unless weights are given."""
    if given:
        pick = F
        for k, w in given.items():
            pick = pick.when(F.col(label) == F.lit(k), F.lit(float(w)))
        return df.withColumn(out, pick.otherwise(F.lit(1.0)))
    df = df.drop(out)
    sizes = class_sizes(df, label)
    whole = sizes.select(F.struct(F.sum("_size").alias("n"), F.count("*").alias("k"))).scalar()
    weights = sizes.select(label, (whole.getField("n") / (whole.getField("k") * F.col("_size"))).alias(out))
    return null_safe_join(df, weights, [label], "left")


def mask_labels(df: DataFrame, key: str, label: str, share: float, seed: int = 42, out: str = "masked") -> DataFrame:
    """Null label on about `share` of the rows."""
    return df.withColumn(out, F.when(unit_hash(key, seed) >= share, F.col(label)))


def repeat(fn: Callable[[int], DataFrame], seeds: Sequence[int], tag: str = "seed") -> DataFrame:
    """Run `fn(seed)` per seed and stack the score tables."""
    out = None
    for s in seeds:
        part = fn(s).withColumn(tag, F.lit(int(s)))
        out = part if out is None else out.unionByName(part)
    return out
