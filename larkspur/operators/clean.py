"""Cleaning, recoding, filters, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.operators.ordered import exact_quantiles, null_safe_join
from larkspur.operators.profile import columns_of


def tokens_to_null(df: DataFrame, tokens: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    cols = cols or columns_of(df, "string")
    return df.withColumns({c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in cols})


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fit_imputer(df: DataFrame, numeric: Sequence[str] = (), strings: Sequence[str] = (), how: str = "median") -> DataFrame:
    """One row with a fill value per column: mean or median for numbers, the most frequent (smallest
    on a tie) for strings."""
    picks = []
    if numeric and how == "mean":
        cells = [F.struct(F.lit(c).alias("column"), F.avg(c).alias("num"), F.lit(None).cast("string").alias("txt")) for c in numeric]
        picks.append(df.agg(F.array(*cells).alias("x")).select(F.inline("x")))
    elif numeric:
        q = exact_quantiles(df, numeric, [0.5])
        picks.append(q.select("column", F.col("q")[0].alias("num"), F.lit(None).cast("string").alias("txt")))
    if strings:
        long = df.select(*[F.col(c).cast("string").alias(c) for c in strings]).unpivot([], list(strings), "column", "txt")
        counts = long.where("txt is not null").groupBy("column", "txt").agg(F.count("*").alias("n"))
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "txt")).alias("b"))
        picks.append(best.select("column", F.lit(None).cast("double").alias("num"), F.col("b.txt").alias("txt")))
    long = picks[0]
    for p in picks[1:]:
        long = long.unionByName(p)
    return long.agg(
        *[F.max(F.when(F.col("column") == c, F.col("num"))).alias(c) for c in numeric],
        *[F.max(F.when(F.col("column") == c, F.col("txt"))).alias(c) for c in strings],
    )


def apply_imputer(df: DataFrame, values: DataFrame) -> DataFrame:
    row = values.select(F.struct(*values.columns)).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), row.getField(c)) for c in values.columns})


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def to_numeric(df: DataFrame, cols: Sequence[str], kind: str = "double") -> DataFrame:
    """Cast; what is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c in cols})


def autocast(df: DataFrame) -> DataFrame:
    """Cast every string column that holds digits only (nulls aside) to bigint; one pass to find them."""
    strings = columns_of(df, "string")
    if not strings:
        return df
    found = df.agg(*[F.bool_and(F.col(c).rlike("^[0-9]+$")).alias(c) for c in strings]).first()
    return df.withColumns({c: F.col(c).cast("bigint") for c in strings if found[c]})


def recode(df: DataFrame, col: str, mapping: Mapping, default=None, keep: bool = False) -> DataFrame:
    """Replace by dictionary. Unmapped values become `default`, or stay as they are with `keep`."""
    out = None
    for old, new in mapping.items():
        hit = F.col(col) == F.lit(old)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return df.withColumn(col, out.otherwise(F.col(col) if keep else F.lit(default)))


def binarize_label(df: DataFrame, col: str, positives: Sequence) -> DataFrame:
    return df.withColumn(col, F.col(col).isin(*positives).cast("int"))


def exclude(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Drop rows holding one of the values; null rows stay, as a plain `!=` keeps them in a data frame."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(*values))


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key. A partial aggregate, so a hot key sends one row per map task."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(key, "_r.*").select(*df.columns)


def count_per_key(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rows per key on every row: pre-aggregated counts joined back, so no key's rows meet in one task."""
    counts = df.groupBy(key).agg(F.count("*").alias(out))
    return null_safe_join(df, counts, [key], "left")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def replace_value(df: DataFrame, col: str, old, new) -> DataFrame:
    return df.withColumn(col, F.when(F.col(col) == F.lit(old), F.lit(new)).otherwise(F.col(col)))


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.trim(F.regexp_replace(col, r"\s+", " ")) != "")


def indicator(col: str | Column, value) -> Column:
    """0 where the column equals the value or is null, else 1 (an absent test counts as not done)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.isNull() | (col == F.lit(value)), F.lit(0)).otherwise(F.lit(1))


def binarize_at(df: DataFrame, col: str, at: float | str, out: str, train: DataFrame | None = None) -> DataFrame:
    """1 above the cut, else 0. `at='median'` learns the cut on `train` (the whole table if not given)."""
    if at == "median":
        cut = exact_quantiles(df if train is None else train, [col], [0.5]).select(F.col("q")[0]).scalar()
    else:
        cut = F.lit(at)
    return df.withColumn(out, (F.col(col) > cut).cast("int"))


def append(df: DataFrame, more: DataFrame) -> DataFrame:
    return df.unionByName(more)


def features_label(df: DataFrame, label: str, drop: Sequence[str] = (), out: str = "features") -> DataFrame:
    """Numeric columns as one vector, the label beside it."""
    from pyspark.ml.feature import VectorAssembler

    feats = [c for c in columns_of(df, "numeric") if c != label and c not in set(drop)]
    return VectorAssembler(inputCols=feats, outputCol=out).transform(df).select(out, label)
