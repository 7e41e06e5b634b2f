"""Group-bys, contingency tables, tests and summaries."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.operators.ordered import exact_quantiles, hash_rank, null_safe_join, running_sums, sample_borders


def group_size(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None, margins: bool = False) -> DataFrame:
    """Counts of `a` against the values of `b`; with margins an `All` row and column.

    The values are found in the data, or listed: then any other value is an error when the rows are read.
    Rows with a null in either column take no part, in the margins neither. A row category called `All`
    stays a row of its own; such a column category is refused with margins."""
    src = df.select(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b)).dropna()
    names = None if values is None else [str(v) for v in values]
    if names is not None:
        other = F.raise_error(F.concat(F.lit(f"{b} holds a value that is not listed: "), F.col(b)))
        src = src.withColumn(b, F.when(F.col(b).isin(names), F.col(b)).otherwise(other))
    wide = src.groupBy(a).pivot(b, names).agg(F.count(F.lit(1)))
    cols = [F.coalesce(F.col(f"`{c.replace('`', '``')}`"), F.lit(0).cast("bigint")).alias(c) for c in wide.columns[1:]]
    wide = wide.select(a, *cols)
    if not margins:
        return wide.orderBy(a)
    if "All" in wide.columns[1:]:
        raise ValueError(f"{b} holds the category All, which is the name of the margin")
    total = wide.agg(F.lit("All").alias(a), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in zip(cols, wide.columns[1:])])
    return wide.union(total).select(a, *cols, sum(cols, F.lit(0).cast("bigint")).alias("All"))


def rate_by_group(df: DataFrame, group: str, label: str, k: int, min_count: int = 0) -> DataFrame:
    """Mean of the label per group, groups with more than `min_count` rows, top k, ties by group."""
    rates = df.groupBy(group).agg(F.avg(label).alias("rate"), F.count("*").alias("n"))
    return rates.where(F.col("n") > min_count).orderBy(F.desc("rate"), group).limit(k)


def rate_report(df: DataFrame, flag: str, label: str) -> DataFrame:
    """Label rate for each value of the flag and for all rows, in one pass."""
    src = df.select(F.col(flag).cast("string").alias("part"), F.col(label).alias("_y"))
    out = src.rollup("part").agg(F.sum("_y").alias("hits"), F.count("*").alias("n"), F.avg("_y").alias("rate"), F.grouping("part").alias("g"))
    return out.select(F.when(F.col("g") == 1, F.lit("all")).otherwise(F.col("part")).alias("part"), "hits", "n", "rate")


def chi_square(df: DataFrame, a: str, b: str, yates: bool | None = None) -> DataFrame:
    """Statistic and degrees of freedom of the independence test; the continuity correction applies
    to a 2x2 table unless switched off."""
    cells = df.groupBy(a, b).agg(F.count("*").alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("ra"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("cb"))
    total = cells.agg(F.sum("n")).scalar()
    n_rows = rows.agg(F.count("*")).scalar()
    n_cols = cols.agg(F.count("*")).scalar()
    inverse = rows.agg(F.sum(1 / F.col("ra"))).scalar() * cols.agg(F.sum(1 / F.col("cb"))).scalar()
    # Empty cells hold expected mass but no row: their share is the total expected mass minus that of
    # the cells seen, as (0 - e)^2 / e = e. In a 2x2 table |n - e| is the same in all four cells, so the
    # corrected statistic needs one of them and the sum of 1 / e, which is total * sum(1/ra) * sum(1/cb).
    seen = null_safe_join(null_safe_join(cells, rows, [a]), cols, [b]).withColumn("e", F.col("ra") * F.col("cb") / total)
    agg = seen.agg(
        F.sum(F.pow(F.col("n") - F.col("e"), 2) / F.col("e")).alias("plain"),
        (F.pow(F.greatest(F.max(F.abs(F.col("n") - F.col("e"))) - 0.5, F.lit(0.0)), 2) * total * inverse).alias("fixed"),
        (total - F.sum("e")).alias("empty"),
    )
    dof = ((n_rows - 1) * (n_cols - 1)).cast("bigint")
    use_fixed = (dof == 1) & F.lit(True if yates is None else yates)
    stat = F.when(use_fixed, F.col("fixed")).otherwise(F.col("plain") + F.col("empty"))
    return agg.select(stat.alias("statistic"), dof.alias("dof"))


def with_p_value(tests: DataFrame) -> DataFrame:
    """`chi_square`'s rows with `p_value`; null where there are no degrees of freedom."""

    @F.pandas_udf("double")
    def tail(statistic: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([chi_square_p(s, int(d)) if d > 0 else None for s, d in zip(statistic, dof)], dtype="float64")

    return tests.withColumn("p_value", tail("statistic", "dof"))


def chi_square_p(statistic: float, dof: int) -> float:
    """Upper tail of the chi-square distribution, by the series or continued fraction of the gamma integral."""
    a, x = dof / 2.0, statistic / 2.0
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * scale


def jarque_bera(df: DataFrame, col: str) -> DataFrame:
    """Normality by skewness and excess kurtosis; p is exact for the chi-square limit with 2 dof."""
    s = df.agg(F.count(col).alias("n"), F.skewness(col).alias("skew"), F.kurtosis(col).alias("kurt"))
    s = s.withColumn("statistic", F.col("n") / 6 * (F.pow("skew", F.lit(2)) + F.pow("kurt", F.lit(2)) / 4))
    return s.withColumn("p_value", F.exp(-F.col("statistic") / 2))


# Published coefficients of a rational approximation of the normal quantile: middle and tails.
QUANTILE_MIDDLE = (
    (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00),
    (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0),
)
QUANTILE_TAIL = (
    (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00),
    (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0),
)
TAIL = 0.02425


def normal_quantile(p: Column) -> Column:
    """The normal value below which a share p lies, 0 < p < 1, to nine digits."""

    def horner(c: Sequence[float], x: Column) -> Column:
        out = F.lit(c[0])
        for a in c[1:]:
            out = out * x + F.lit(a)
        return out

    low = F.least(p, 1 - p)
    q, t = low - 0.5, F.sqrt(-2 * F.log(low))
    middle = horner(QUANTILE_MIDDLE[0], q * q) * q / horner(QUANTILE_MIDDLE[1], q * q)
    value = F.when(low < TAIL, horner(QUANTILE_TAIL[0], t) / horner(QUANTILE_TAIL[1], t)).otherwise(middle)
    return F.when(p > 0.5, -value).otherwise(value)


def shapiro_francia(df: DataFrame, key: str, col: str) -> DataFrame:
    """(n, statistic, z, p_value): normality by the squared correlation of the ordered values with normal scores.

    Values are ranked in two levels, rows of equal value by hash of their unique key, so that no task orders the whole
    column or all rows of one value. z is the normal deviate of log(1 - statistic), meant for 5 to 5,000 rows; p_value
    its upper tail. Null values are left out; with fewer than 5 rows or one value all but n is null.
    """
    rows = df.select(F.col(key).alias("k"), F.col(col).cast("double").alias("x")).where("x is not null and not isnan(x)")
    values = rows.groupBy("x").agg(F.count("*").alias("n"))
    before = running_sums(values, [], "x", ["n"], sample_borders(values, "x")).select("x", (F.col("cum_n") - F.col("n")).alias("before"))
    n, mean = rows.agg(F.count("*")).scalar(), rows.agg(F.avg("x")).scalar()
    place = (F.col("before") + F.col("r") + 1 - 0.375) / (n + 0.25)
    placed = hash_rank(rows, "k", within=["x"], out="r").join(before, "x").select((F.col("x") - mean).alias("d"), normal_quantile(place).alias("m"))
    out = placed.agg(F.count("*").alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(a + b) for a, b in (("m", "d"), ("m", "m"), ("d", "d"))])
    usable = (F.col("n") >= 5) & (F.col("dd") > 0)
    out = out.select("n", usable.alias("usable"), F.when(usable, F.col("md") * F.col("md") / (F.col("mm") * F.col("dd"))).alias("statistic"))
    u, v = F.log("n"), F.log(F.log("n"))
    z = (F.log(1 - F.col("statistic")) - (-1.2725 + 1.0521 * (v - u))) / (1.0308 - 0.26758 * (v + 2 / u))
    return out.select("n", "statistic", F.when(F.col("usable"), z).alias("z")).withColumn("p_value", _upper_tail("z"))


def _upper_tail(z: str) -> Column:
    @F.pandas_udf("double")
    def tail(v: pd.Series) -> pd.Series:
        return v.map(lambda x: 0.5 * math.erfc(x / math.sqrt(2)), na_action="ignore")

    return tail(F.col(z))


def score_table(scores: DataFrame, by: str, score: str = "score") -> DataFrame:
    """Count, mean, population std, min, quartiles and max per parameter value."""
    base = scores.groupBy(by).agg(
        F.count(score).alias("n"),
        F.avg(score).alias("mean"),
        F.stddev_pop(score).alias("std"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
    )
    q = exact_quantiles(scores, [score], [0.25, 0.5, 0.75], by=[by])
    q = q.select(by, F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"))
    return null_safe_join(base, q, [by], "left")


def mean_ci(scores: DataFrame, score: str = "score") -> DataFrame:
    s = scores.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.count(score).alias("n"))
    half = 1.96 * F.col("std") / F.sqrt("n")
    return s.select("mean", "std", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), list(values), "variable", "value")


def top_k(df: DataFrame, by: str, k: int, tie: str, absolute: bool = True) -> DataFrame:
    key = F.abs(by) if absolute else F.col(by)
    return df.orderBy(key.desc(), tie).limit(k)
