"""Linear models in the units of the usual objective
(1/2n)|y - Xw|^2 + alpha l1 |w|_1 + alpha (1 - l1)/2 |w|^2, fitted by pyspark.ml.

Spark scales the label by its standard deviation inside, so the L2 part needs that factor back;
`_penalty` does the conversion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

FEATURES = "features"


def with_features(feats: Sequence[str] | str, estimator) -> Pipeline:
    """The estimator alone on a vector column, or behind an assembler of numeric columns."""
    if isinstance(feats, str):
        return Pipeline(stages=[estimator.setFeaturesCol(feats)])
    return Pipeline(stages=[VectorAssembler(inputCols=list(feats), outputCol=FEATURES, handleInvalid="keep"), estimator.setFeaturesCol(FEATURES)])


def _penalty(df: DataFrame, y: str, alpha: float, l1_ratio: float) -> tuple[float, float]:
    spread = df.agg(F.stddev_pop(y)).first()[0]
    reg = alpha * l1_ratio + spread * alpha * (1 - l1_ratio)
    return reg, (alpha * l1_ratio / reg if reg else 0.0)


def fit_ols(df: DataFrame, feats: Sequence[str] | str, y: str) -> PipelineModel:
    return with_features(feats, LinearRegression(labelCol=y, regParam=0.0, solver="normal")).fit(df)


def fit_elastic_net(df: DataFrame, feats: Sequence[str] | str, y: str, alpha: float, l1_ratio: float) -> PipelineModel:
    reg, net = _penalty(df, y, alpha, l1_ratio)
    lr = LinearRegression(labelCol=y, regParam=reg, elasticNetParam=net, standardization=False, maxIter=1000, tol=1e-9)
    return with_features(feats, lr).fit(df)


def fit_lasso(df: DataFrame, feats: Sequence[str] | str, y: str, alpha: float) -> PipelineModel:
    return fit_elastic_net(df, feats, y, alpha, 1.0)


def fit_ridge(df: DataFrame, feats: Sequence[str] | str, y: str, alpha: float) -> PipelineModel:
    """Penalty on the sum of squares: |y - Xw|^2 + alpha |w|^2."""
    return fit_elastic_net(df, feats, y, alpha / df.count(), 0.0)


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and R2 of one feature, in one aggregate."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def logistic(df: DataFrame, label: str, C: float = 1.0, penalty: str = "l2", weight: str | None = None) -> LogisticRegression:
    """Estimator with regParam = 1 / (C * sum of weights). `C=inf` is no penalty."""
    total = df.agg(F.sum(weight) if weight else F.count("*")).first()[0]
    lr = LogisticRegression(
        labelCol=label, standardization=False, regParam=1.0 / (C * total), elasticNetParam=1.0 if penalty == "l1" else 0.0, maxIter=500, tol=1e-8
    )
    return lr.setWeightCol(weight) if weight else lr


def fit_logistic(df: DataFrame, feats: Sequence[str] | str, label: str, C: float = 1.0, penalty: str = "l2", weight: str | None = None) -> PipelineModel:
    return with_features(feats, logistic(df, label, C, penalty, weight)).fit(df)


def fit_softmax(df: DataFrame, feats: Sequence[str] | str, label: str) -> PipelineModel:
    """Linear softmax without penalty."""
    lr = LogisticRegression(labelCol=label, family="multinomial", regParam=0.0, maxIter=500)
    return with_features(feats, lr).fit(df)


def rank_features(model: PipelineModel, names: Sequence[str], n: int | None = None) -> DataFrame:
    """Coefficients (or importances) by absolute value, largest first; `is_zero` marks the unused."""
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(c, float(v), abs(float(v)), bool(v == 0)) for c, v in zip(names, values.toArray())]
    spark = model_session()
    out = spark.createDataFrame(rows, "feature string, value double, size double, is_zero boolean").orderBy(F.desc("size"), "feature")
    return out.limit(n) if n else out


def model_session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()
