"""Encoding, scaling, transforms and feature choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.operators.ordered import null_safe_join, position

CATEGORY_LIMIT = 1000  # wide one-hot columns per input column


def fit_categories(df: DataFrame, cols: Sequence[str], limit: int = CATEGORY_LIMIT) -> dict[str, list]:
    """Sorted categories per column; refuses a column with more than `limit`."""
    out = {}
    for c in cols:
        rows = df.select(c).where(F.col(c).isNotNull()).distinct().limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"{c} has more than {limit} categories")
        out[c] = sorted(r[0] for r in rows)
    return out


def one_hot(
    df: DataFrame, categories: Mapping[str, Sequence], null_indicator: bool = False, drop_first: bool = False
) -> DataFrame:
    """0/1 column `<col>_<value>` per category; an unknown value gives zeros."""
    new = {}
    for c, values in categories.items():
        for v in list(values)[1 if drop_first else 0:]:
            new[f"{c}_{v}"] = F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
        if null_indicator:
            new[f"{c}_null"] = F.col(c).isNull().cast("int")
    return df.withColumns(new).drop(*categories)


def align_columns(df: DataFrame, like: Sequence[str], fill=0) -> DataFrame:
    """Exactly the columns of `like`, in that order; absent columns and nulls are `fill`."""
    have = set(df.columns)
    return df.select([F.coalesce(F.col(c), F.lit(fill)).alias(c) if c in have else F.lit(fill).alias(c) for c in like])


def label_encode(df: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Code 0..k-1 in sorted order of the distinct values, null = -1."""
    for c in cols:
        values = df.select(c).where(F.col(c).isNotNull()).distinct()
        codes = position(values, c, out=f"{c}{suffix}")
        df = null_safe_join(df, codes, [c], "left").withColumn(
            f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), F.lit(-1)).cast("bigint")
        )
    return df


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: a struct (mean, population std) per column; std 0 becomes 1."""
    return df.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"),
                F.when(F.stddev_pop(c) == 0, F.lit(1.0)).otherwise(F.stddev_pop(c)).alias("std"),
            ).alias(c)
            for c in cols
        ]
    )


def apply_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    row = params.select(F.struct(*params.columns)).scalar()
    return df.withColumns(
        {c: (F.col(c) - row.getField(c).getField("mean")) / row.getField(c).getField("std") for c in params.columns}
    )


def log_target(df: DataFrame, col: str, how: str = "log1p") -> DataFrame:
    """`log1p`, its inverse `expm1`, or `log`."""
    fn = {"log1p": F.log1p, "expm1": F.expm1, "log": F.log}[how]
    return df.withColumn(col, fn(F.col(col).cast("double")))


def yeo_johnson(x: Column, lam: Column) -> Column:
    upper = F.when(lam == 0, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / F.nullif(lam, F.lit(0.0)))
    lower = F.when(lam == 2, -F.log1p(-x)).otherwise((1 - F.pow(1 - x, 2 - lam)) / F.nullif(2 - lam, F.lit(0.0)))
    return F.when(x >= 0, upper).otherwise(lower)


def yeo_johnson_profile(df: DataFrame, col: str, grid: Sequence[float]) -> DataFrame:
    """Log likelihood per lambda, all in one pass over the column."""
    x = F.col("x")
    lams = F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("lam")
    rows = df.select(F.col(col).cast("double").alias("x")).where(x.isNotNull()).select("x", lams)
    jac = (F.col("lam") - 1) * F.sum(F.signum(x) * F.log1p(F.abs(x)))
    fit = -F.count("*") / 2 * F.log(F.var_pop(yeo_johnson(x, F.col("lam"))))
    return rows.groupBy("lam").agg((fit + jac).alias("loglik"))


def fit_yeo_johnson(df: DataFrame, col: str, lo: float = -2.0, hi: float = 4.0, rounds: int = 5, width: int = 13) -> float:
    """Best lambda by narrowing a grid; each round is one pass over the column."""
    best = lo
    for _ in range(rounds):
        step = (hi - lo) / (width - 1)
        grid = [lo + i * step for i in range(width)]
        rows = yeo_johnson_profile(df, col, grid).collect()
        best = max((r for r in rows if r["loglik"] is not None), key=lambda r: r["loglik"])["lam"]
        lo, hi = best - step, best + step
    return best


def apply_yeo_johnson(df: DataFrame, col: str, lam: float, out: str) -> DataFrame:
    """Transform, then standardize."""
    df = df.withColumn(out, yeo_johnson(F.col(col).cast("double"), F.lit(lam)))
    return apply_scaler(df, fit_scaler(df, [out]))


def _corr(a: str, b: str) -> Column:
    """Pearson correlation over rows with both values, null where one of the columns has no variance."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation in long form, one row per pair a < b in column order, with positions. Each pair
    counts the rows that have both values; a column without variance there gives null."""
    cols = list(cols)
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(cols.index(b)).alias("pos_b"), _corr(a, b).alias("r"))
        for a, b in combinations(cols, 2)
    ]
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


def prune_correlated(corr: DataFrame, threshold: float = 0.95, how: str = "later") -> DataFrame:
    """Columns to drop: the later member of each pair above the threshold, or `both`."""
    hit = corr.where(F.abs("r") > threshold)
    drop = hit.select(F.col("b").alias("column"))
    if how == "both":
        drop = drop.union(hit.select(F.col("a").alias("column")))
    return drop.distinct()


def select_by_target_corr(df: DataFrame, cols: Sequence[str], target: str, threshold: float = 0.2) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), _corr(c, target).alias("r")) for c in cols]
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c")).where(F.abs("r") > threshold)


def constant_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), F.var_samp(c).alias("variance")) for c in cols]
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c")).where("variance = 0").select("column")


def drop_constant(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*[r[0] for r in constant_columns(df, cols).collect()])


def fit_pca(df: DataFrame, feats: Sequence[str] | str, k: int | None = None, share: float | None = None):
    """Centred PCA: (scaler model, PCA model). With `share`, the fewest components that reach it."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

    stages = []
    if isinstance(feats, str):
        vec, cur = feats, df
    else:
        va = VectorAssembler(inputCols=list(feats), outputCol="_raw")
        stages.append(va)
        vec, cur = "_raw", va.transform(df)
    center = StandardScaler(inputCol=vec, outputCol="_centred", withMean=True, withStd=False).fit(cur)
    cur = center.transform(cur)
    width = len(cur.select("_centred").first()[0])
    model = PCA(k=k or width, inputCol="_centred", outputCol="pca").fit(cur)
    if share is not None:
        total, need = 0.0, width
        for i, v in enumerate(model.explainedVariance.toArray(), 1):
            total += v
            if total >= share:
                need = i
                break
        model = PCA(k=need, inputCol="_centred", outputCol="pca").fit(cur)
    return PipelineModel([*stages, center, model])


def column_transformer(cat: Sequence[str], num: Sequence[str], estimator=None):
    """One-hot strings, standardized numbers, then an optional estimator, as one ml Pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    stages = []
    if cat:
        stages.append(
            StringIndexer(
                inputCols=list(cat), outputCols=[f"{c}_ix" for c in cat], handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        stages.append(OneHotEncoder(inputCols=[f"{c}_ix" for c in cat], outputCols=[f"{c}_oh" for c in cat], dropLast=False, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=list(num), outputCol="_num", handleInvalid="keep"))
    stages.append(StandardScaler(inputCol="_num", outputCol="_scaled", withMean=True, withStd=True))
    stages.append(VectorAssembler(inputCols=[f"{c}_oh" for c in cat] + ["_scaled"], outputCol="features"))
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)


def label_indicators(df: DataFrame, label: str, classes: Sequence) -> DataFrame:
    return df.withColumns({f"is_{k}": (F.col(label) == F.lit(k)).cast("int") for k in classes})


def mutual_info(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Mutual information in nats of each categorical column with the label."""
    long = df.select(F.col(label).alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ["_y"], list(cols), "column", "value"
    )
    joint = long.groupBy("column", "value", "_y").agg(F.count("*").alias("n"))
    px = joint.groupBy("column", "value").agg(F.sum("n").alias("nx"))
    py = joint.groupBy("column", "_y").agg(F.sum("n").alias("ny"))
    total = df.agg(F.count("*")).scalar()
    cells = null_safe_join(null_safe_join(joint, px, ["column", "value"]), py, ["column", "_y"])
    term = F.col("n") / total * F.log(F.col("n") * total / (F.col("nx") * F.col("ny")))
    return cells.groupBy("column").agg(F.sum(term).alias("mutual_info"))
