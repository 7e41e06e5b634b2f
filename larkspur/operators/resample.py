"""Synthetic minority rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.operators.neighbors import nearest, points
from larkspur.operators.ordered import hash_order, hash_rank, unit_hash
from larkspur.operators.split import COPY_LOT, class_sizes


def _per_class(label: str, values: Mapping) -> Column:
    out = F
    for c, v in values.items():
        out = out.when(F.col(label) == F.lit(c), F.lit(v))
    return out


def smote(
    df: DataFrame, key: str, feats: str | list, label: str, targets: Mapping | None = None, k: int = 5, seed: int = 42
) -> DataFrame:
    """(label, v, base, neighbor, copy): the rows of `df` plus, per class below its target (default: the
    largest class), made-up rows x + u (neighbour - x) on the segment to one of the k nearest rows of the
    class. Base row, neighbour and u come from hashes.

    All classes share one neighbour search: an extra coordinate moves the classes farther apart than
    any two rows of one class can be, so rows of the own class always come first.
    """
    sizes = {r[0]: r["_size"] for r in class_sizes(df, label).collect()}
    goal = dict(targets) if targets else {c: max(sizes.values()) for c in sizes}
    extra = {c: goal[c] - sizes[c] for c in goal if goal[c] > sizes.get(c, 0)}
    for c in extra:
        if sizes.get(c, 0) < 2:
            raise ValueError(f"class {c!r} needs at least two rows")
    labels = df.select(F.col(key).alias("id"), F.col(label))
    real = points(df, key, feats).join(labels, "id")
    none = F.lit(None).cast(df.schema[key].dataType)
    out = real.select(label, "v", F.col("id").alias("base"), none.alias("neighbor"), F.lit(0).cast("bigint").alias("copy"))
    if not extra:
        return out
    minority = real.where(F.col(label).isin(*extra))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    apart = 2.5 * (minority.agg(F.max(norm)).first()[0] or 1.0) + 1.0
    shift = _per_class(label, {c: apart * i for i, c in enumerate(extra)})
    moved = minority.withColumn("v", F.concat("v", F.array(shift)))
    near = nearest(moved, moved, "id", "v", k, exclude_self=True).select("id", "rank", "neighbor")

    # every row is a base floor(extra / n) times, the first extra % n in hash order once more
    base = hash_rank(minority, "id", f"{seed}base", within=[label], out="_r")
    whole = _per_class(label, {c: extra[c] // sizes[c] for c in extra})
    once_more = F.col("_r") < _per_class(label, {c: extra[c] % sizes[c] for c in extra})
    base = base.withColumn("_times", whole.cast("bigint") + once_more.cast("bigint")).where("_times > 0")
    base = base.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / COPY_LOT))))
    first, last = F.col("_lot") * COPY_LOT + 1, F.least((F.col("_lot") + 1) * COPY_LOT, F.col("_times"))
    base = base.withColumn("copy", F.explode(F.sequence(first, last)))
    draw = F.concat(F.col("id"), F.lit("/"), F.col("copy"))
    choices = _per_class(label, {c: min(k, sizes[c] - 1) for c in extra})
    base = base.withColumn("rank", (hash_order(draw, f"{seed}pick") % choices + 1).cast("int"))
    base = base.withColumn("u", unit_hash(draw, f"{seed}u")).join(near, ["id", "rank"])
    ends = minority.select(F.col("id").alias("neighbor"), F.col("v").alias("w"))
    made = base.join(ends, "neighbor").select(
        label, F.transform(F.arrays_zip("v", "w"), _between(F.col("u"))).alias("v"), F.col("id").alias("base"), "neighbor", "copy"
    )
    return out.unionByName(made)


def _between(u: Column):
    return lambda p: p["v"] + u * (p["w"] - p["v"])
