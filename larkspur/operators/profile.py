"""Profiling: shape, summaries, nulls, counts, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from larkspur.operators.ordered import exact_quantiles



def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Column names of one kind: `numeric`, `string`, `boolean` or `array`."""
    kinds = {"numeric": T.NumericType, "string": T.StringType, "boolean": T.BooleanType, "array": T.ArrayType}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind])]


def profile_shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the row count of the table."""
    cells = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
        )
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.inline(F.array(*cells)))


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max per column, one row each."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in cols
    ]
    moments = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    q = q.select("column", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"))
    return moments.join(q, "column", "left")


def _long_counts(df: DataFrame, test) -> DataFrame:
    aggs = [F.struct(F.lit(c).alias("column"), F.count_if(test(c)).alias("n_missing")) for c in df.columns]
    return df.agg(F.array(*aggs).alias("cells"), F.count("*").alias("_rows")).select("_rows", F.inline("cells"))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with nulls, and how many."""
    return _long_counts(df, lambda c: F.col(c).isNull()).where("n_missing > 0").select("column", "n_missing")


def missing_report(df: DataFrame, tokens: Sequence[str] = ("?",)) -> DataFrame:
    """Missing values per column, a null or a token, with the percent of rows; most missing first."""
    strings = set(columns_of(df, "string"))

    def test(c: str) -> Column:
        null = F.col(c).isNull()
        return null | F.col(c).isin(*tokens) if c in strings else null

    long = _long_counts(df, test)
    pct = (F.lit(100.0) * F.col("n_missing") / F.col("_rows")).alias("percent")
    return long.select("column", "n_missing", pct).orderBy(F.desc("n_missing"), "column")


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    if normalize:
        counts = counts.withColumn("share", F.col("n") / df.agg(F.count("*")).scalar())
    return counts


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates")
    )


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    """Largest class size over smallest."""
    return df.groupBy(label).agg(F.count("*").alias("_n")).agg(
        F.max("_n").alias("largest"), F.min("_n").alias("smallest"), (F.max("_n") / F.min("_n")).alias("ratio")
    )


def distinct_per_fold(df: DataFrame, cols: Sequence[str], fold: str, k: int) -> DataFrame:
    """Distinct values per column in the train part and the test part of every fold.

    A value is in the train part of fold f when it occurs in any other fold, so one small table
    (column, value, folds it occurs in) answers all k folds.
    """
    seen = df.select(fold, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [fold], list(cols), "column", "value"
    )
    seen = seen.where("value is not null").groupBy("column", "value").agg(F.collect_set(fold).alias("folds"))
    each = seen.select("column", "folds", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    inside = F.array_contains("folds", F.col("fold"))
    outside = F.size("folds") > F.when(inside, 1).otherwise(0)
    return each.groupBy("fold", "column").agg(
        F.count_if(outside).alias("train_distinct"), F.count_if(inside).alias("test_distinct")
    )


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Counts in equal-width bins between min and max; the top border belongs to the last bin."""
    span = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    edge = span.select(F.struct("lo", "hi")).scalar()
    width = (edge.getField("hi") - edge.getField("lo")) / bins
    raw = F.when(width == 0, F.lit(0)).otherwise(F.floor((F.col(col) - edge.getField("lo")) / F.nullif(width, F.lit(0.0))))
    binned = df.where(F.col(col).isNotNull()).select(F.least(raw, F.lit(bins - 1)).cast("bigint").alias("bin"))
    return binned.groupBy("bin").agg(F.count("*").alias("n"))


def five_number(df: DataFrame, group: str, col: str) -> DataFrame:
    """Min, quartiles and max per group."""
    q = exact_quantiles(df, [col], [0.0, 0.25, 0.5, 0.75, 1.0], by=[group])
    names = ["min", "q25", "q50", "q75", "max"]
    return q.select(group, *[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def non_numeric_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is present but is no number."""
    return df.where(F.col(col).isNotNull() & F.col(col).try_cast("double").isNull())


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


