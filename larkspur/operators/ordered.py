"""Ranks, running sums and exact quantiles without a single-task sort.

A global or per-class `row_number` puts a class into one task. Here the order is cut
into bins first: per-bin totals form a small table, its running sums give each bin an
offset, and the fine order is worked out inside a bin only. Bin borders decide how even
the tasks are, never what the answer is, and they are literals once learned, so that a
recomputed task sees the same bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from larkspur.session import settle

RANK_BITS = 12
MAX_RANK_BITS = 18
MAX_BINS = 1024
SKETCH = 10_000  # a sketch is off by at most one row in so many
GRID = 256  # quantiles by which a later read narrows the bounds
LOT = 1_000_000  # values of one quantile that a task orders; with more, another read narrows them
SMALL = 10_000  # bounds that go to every task; with more, rows and bounds meet in a shuffle by group


def hash_order(key: str | Column, seed: int | str = 42) -> Column:
    """First 8 hex digits of md5(key|seed) as a number in [0, 2^32)."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def unit_hash(key: str | Column, seed: int | str = 42) -> Column:
    """`hash_order` scaled to [0, 1)."""
    return hash_order(key, seed) / F.lit(float(2**32))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal names where null equals null; the right keys are dropped."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])


def hash_rank(
    df: DataFrame,
    key: str,
    seed: int | str = 42,
    within: Sequence[str] = (),
    out: str = "rank",
    size: str | None = None,
    bits: int | None = None,
) -> DataFrame:
    """0-based rank of each row by hash of its unique key, per `within` group. `size` names a column for
    the row count of the group, which falls out of the same small table."""
    if bits is None:  # a few bins per shuffle partition
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bits = max(RANK_BITS, min(MAX_RANK_BITS, width.bit_length() + 2))
    rows = df.withColumn("_h", hash_order(key, seed)).withColumn("_bin", F.shiftright("_h", 32 - bits))
    return _rank_in_bins(rows, list(within), [F.col("_h"), F.col(key)], out, size).drop("_h", "_bin")


def _rank_in_bins(rows: DataFrame, within: list[str], order: list[Column], out: str, size: str | None = None) -> DataFrame:
    sizes = rows.groupBy(*within, "_bin").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*within)
    before = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    # one struct as the key: nulls inside compare equal, and the window and the join share one shuffle
    slot = F.struct(*within, "_bin").alias("_slot_key")
    parts = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    if size:
        parts.append(F.sum("_n").over(group).alias(size))
    offsets = sizes.select(slot, *parts)
    local = F.row_number().over(Window.partitionBy("_slot_key").orderBy(*order)).alias("_local")
    ranked = rows.select("*", slot).select("*", local)
    joined = ranked.join(offsets, "_slot_key").withColumn(out, F.col("_off") + F.col("_local") - 1)
    return joined.drop("_slot_key", "_off", "_local")


def bin_count(df: DataFrame) -> int:
    """Bins follow the width of the shuffles, within fixed bounds."""
    return max(16, min(MAX_BINS, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def sample_borders(df: DataFrame, col: str, bins: int | None = None, per_bin: int = 16) -> list:
    """Borders that cut the distinct values of `col` into about equal bins.

    The rows with the smallest hashes are a uniform draw of the values; Spark keeps only
    `bins * per_bin` of them per task, so what reaches the driver is bounded.
    """
    bins = bins or bin_count(df)
    take = bins * per_bin
    got = df.select(col).where(F.col(col).isNotNull()).orderBy(F.xxhash64(col)).limit(take).collect()
    values = sorted({r[0] for r in got})
    step = max(1, len(values) // bins)
    return values[step::step][: bins - 1]


def _at_or_below(cuts: Column, value: Column) -> Column:
    return F.size(F.filter(cuts, lambda b: b <= value))


def with_bins(df: DataFrame, borders: dict[str, list], out: dict[str, str]) -> DataFrame:
    """Add `out[c]`, how many of `borders[c]` lie at or below c. Numbers go through `Bucketizer`, whose
    binary search stays cheap for many borders; a cast to double keeps the order, which is all bins need."""
    numeric = [c for c in borders if borders[c] and isinstance(df.schema[c].dataType, T.NumericType)]
    if numeric:
        ready = df.withColumns({f"_b_{c}": F.col(c).cast("double") for c in numeric})
        splits = [[float("-inf"), *sorted({float(b) for b in borders[c]}), float("inf")] for c in numeric]
        bucket = Bucketizer(
            inputCols=[f"_b_{c}" for c in numeric],
            outputCols=[f"_o_{c}" for c in numeric],
            splitsArray=splits,
            handleInvalid="keep",
        )
        df = bucket.transform(ready).drop(*[f"_b_{c}" for c in numeric])
        df = df.withColumns({out[c]: F.coalesce(F.col(f"_o_{c}").cast("int"), F.lit(0)) for c in numeric})
        df = df.drop(*[f"_o_{c}" for c in numeric])
    for c in set(borders) - set(numeric):
        if borders[c]:
            cuts = F.array(*[F.lit(b) for b in borders[c]])
            df = df.withColumn(out[c], F.when(F.col(c).isNull(), 0).otherwise(_at_or_below(cuts, F.col(c))))
        else:
            df = df.withColumn(out[c], F.lit(0))
    return df


def position(df: DataFrame, key: str, out: str = "position", bins: int | None = None) -> DataFrame:
    """0-based position of each row in the order of its unique key."""
    rows = with_bins(df, {key: sample_borders(df, key, bins)}, {key: "_bin"})
    return _rank_in_bins(rows, [], [F.col(key)], out).drop("_bin")


def running_sums(
    df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str], borders: list, descending: bool = False
) -> DataFrame:
    """Inclusive running sums of `sums` over distinct `order` values, per group; adds `cum_<name>`."""
    by = list(by)
    rows = with_bins(df, {order: borders}, {order: "_bin"})
    totals = rows.groupBy(*by, "_bin").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    bin_key = F.col("_bin").desc() if descending else F.col("_bin").asc()
    val_key = F.col(order).desc() if descending else F.col(order).asc()
    before = Window.partitionBy(*by).orderBy(bin_key).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bin", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums]
    )
    offsets = offsets.select(F.struct(*by, "_bin").alias("_slot_key"), *[f"_o_{c}" for c in sums])
    inside = Window.partitionBy("_slot_key").orderBy(val_key).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", F.struct(*by, "_bin").alias("_slot_key"))
    joined = local.select("*", *[F.sum(c).over(inside).alias(f"_s_{c}") for c in sums]).join(offsets, "_slot_key")
    for c in sums:
        joined = joined.withColumn(f"cum_{c}", F.col(f"_o_{c}") + F.col(f"_s_{c}"))
    return joined.drop("_bin", "_slot_key", *[f"_o_{c}" for c in sums], *[f"_s_{c}" for c in sums])


def value_borders(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list]:
    """Approximate quantiles per column as bin borders."""
    probs = [i / bins for i in range(1, bins)]
    aggs = [F.percentile_approx(F.col(c).cast("double"), probs, 4 * bins).alias(f"b{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs).first()
    return {c: sorted(set(row[f"b{i}"] or [])) for i, c in enumerate(cols)}


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), sketch: int = SKETCH, grid: int = GRID, lot: int = LOT
) -> DataFrame:
    """Linear-interpolated exact quantiles, one row per group and column, quantiles in array `q` (null without values;
    NaN counts as the largest value).

    Two reads. The first is a mergeable sketch per group and column, which is off by at most one row in `sketch`, so
    the values around each wanted rank are certain to lie between two of its quantiles. The second counts the values
    below these bounds and orders the distinct ones between them: at most ten in `sketch` of the group's rows. Where
    that can exceed `lot` values, reads in between narrow the bounds by a `grid` of quantiles of what lies inside.
    """
    if grid < 12 or lot < 10:
        raise ValueError("a read narrows the bounds only with a grid of 12 or more, and to no fewer than 10 values")
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    who = [*by, "column"]
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    long = df.select(*by, F.inline(F.array(*cells)))
    near = [min(1.0, max(0.0, p + d / sketch)) for p in probs for d in (-4, 4)]
    whole = long.groupBy(*who).agg(F.count("value").alias("n"), F.percentile_approx(F.nanvl("value", F.lit(float("inf"))), near, sketch).alias("b"))
    bounds = [
        # a small group is ordered as a whole
        F.struct(
            F.when(F.col("n") > sketch, F.col("b")[2 * i]).otherwise(F.lit(float("-inf"))).alias("lo"),
            F.when(F.col("n") > sketch, _up_to_nan(F.col("b")[2 * i + 1])).otherwise(F.lit(float("nan"))).alias("hi"),
        )
        for i in range(len(probs))
    ]
    whole = settle(whole.select(*who, "n", F.array(*bounds).alias("bounds")))
    groups, largest = whole.agg(F.count("*"), F.max("n")).first()
    few = groups * len(probs) <= SMALL
    most = 10 * (largest or 0) / sketch
    while most > lot:
        whole = settle(_narrowed(_spots(long, whole, who, probs, few), whole, who, grid))
        most = 6 * most / grid + 2
    found = _at_ranks(_counted(long, whole, who, probs, few), who)
    return null_safe_join(whole.select(*who), found, who, "left")


def _up_to_nan(value: Column) -> Column:
    """A sketch holds NaN as infinity."""
    return F.when(value == float("inf"), F.lit(float("nan"))).otherwise(value)


def _with_bounds(rows: DataFrame, whole: DataFrame, who: list, few: bool) -> DataFrame:
    """The bounds of a few groups go to the rows. In a shuffle by group each of a few groups would be one task's, and
    Spark keeps to the shuffle where most partitions of the bounds are empty, however small these are."""
    return null_safe_join(rows, F.broadcast(whole) if few else whole, who)


def _spots(long: DataFrame, whole: DataFrame, who: list, probs: list, few: bool) -> DataFrame:
    """(group, column, i, at, value): the values up to the upper bound of quantile i, null for one below the lower
    bound. `at` is the wanted rank, from 0, with its fraction."""
    held = _with_bounds(long.where(F.col("value").isNotNull()), whole, who, few)
    return _placed(held, who, probs)


def _placed(held: DataFrame, who: list, probs: list, *more: str) -> DataFrame:
    spots = []
    for i, p in enumerate(probs):
        bound = F.col("bounds")[i]
        value = F.when(F.col("value") >= bound["lo"], F.col("value"))
        spots.append(F.when(F.col("value") <= bound["hi"], F.struct(F.lit(i).alias("i"), (F.lit(p) * (F.col("n") - 1)).alias("at"), value.alias("value"))))
    return held.select(*who, *more, F.explode(F.array_compact(F.array(*spots))).alias("s")).select(*who, *more, "s.*")


def _counted(long: DataFrame, whole: DataFrame, who: list, probs: list, few: bool) -> DataFrame:
    """As `_spots`, with `rows` of equal values. Values outside all bounds are counted per gap between lower bounds
    before they fan out over the quantiles, one value standing for the gap."""
    held = _with_bounds(long.where(F.col("value").isNotNull()), whole, who, few)
    value = F.col("value")
    inside = F.exists("bounds", lambda b: (value >= b["lo"]) & (value <= b["hi"]))
    gap = F.size(F.filter("bounds", lambda b: value >= b["lo"]))
    cells = held.select(*who, "value", F.when(inside, value).alias("_in"), gap.alias("_gap"))
    cells = cells.groupBy(*who, "_gap", "_in").agg(F.min("value").alias("value"), F.count("*").alias("rows"))
    return _placed(_with_bounds(cells, whole, who, few), who, probs, "rows")


def _narrowed(spots: DataFrame, whole: DataFrame, who: list, grid: int) -> DataFrame:
    """`whole` with closer bounds, from a grid of quantiles of the values inside the bounds."""
    value = F.nanvl("value", F.lit(float("inf")))
    marks = F.percentile_approx(value, [g / grid for g in range(grid + 1)], 4 * grid)
    ends = [F.min("value").alias("lo"), F.max("value").alias("hi")]
    per = spots.groupBy(*who, "i", "at").agg(F.count_if(F.col("value").isNull()).alias("below"), F.count("value").alias("m"), marks.alias("marks"), *ends)
    # places on the grid that lie a step or more beyond the wanted ranks, which the sketch can't miss
    first = F.floor((F.floor("at") - F.col("below") + 1) * grid / F.col("m")).cast("int") - 1
    last = F.ceil((F.ceil("at") - F.col("below") + 1) * grid / F.col("m")).cast("int") + 1
    wide = F.col("m") > 4 * grid
    lo = F.when(wide & (first >= 0), F.get("marks", first)).otherwise(F.col("lo"))
    hi = F.when(wide & (last <= grid), _up_to_nan(F.get("marks", last))).otherwise(F.col("hi"))
    bounds = per.groupBy(*who).agg(F.array_sort(F.collect_list(F.struct("i", lo.alias("lo"), hi.alias("hi")))).alias("bounds"))
    return null_safe_join(whole.select(*who, "n"), bounds, who, "left")


def _at_ranks(spots: DataFrame, who: list) -> DataFrame:
    """(group, column, q) from the distinct values between the bounds, their rows counted before they are ordered."""
    spots = spots.groupBy(*who, "i", "at", "value").agg(F.sum("rows").alias("rows"))
    order = Window.partitionBy(*who, "i").orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    spots = spots.withColumn("upto", F.sum("rows").over(order))
    held = lambda rank: F.max(F.when((rank < F.col("upto")) & (rank >= F.col("upto") - F.col("rows")), F.col("value")))
    pair = spots.groupBy(*who, "i").agg(held(F.floor("at")).alias("lo"), held(F.ceil("at")).alias("hi"), F.max("at").alias("at"))
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at")))
    ordered = F.array_sort(F.collect_list(F.struct("i", value.alias("value"))))
    return pair.groupBy(*who).agg(F.transform(ordered, lambda s: s["value"]).alias("q"))
