"""Tree, boosted, margin and network classifiers of pyspark.ml, and k nearest neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, functions as F

from larkspur.models.linear import with_features
from larkspur.operators.neighbors import nearest
from larkspur.session import set_checkpoints


def fit_tree(df: DataFrame, feats, label: str, depth: int = 5, seed: int = 42) -> PipelineModel:
    return with_features(feats, DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=seed)).fit(df)


def forest(label: str, trees: int = 100, depth: int = 5, strategy: str = "sqrt", weight: str | None = None, seed: int = 42) -> RandomForestClassifier:
    rf = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy=strategy, seed=seed)
    return rf.setWeightCol(weight) if weight else rf


def fit_forest(df: DataFrame, feats, label: str, trees: int = 100, depth: int = 5, strategy: str = "sqrt", weight: str | None = None, seed: int = 42) -> PipelineModel:
    return with_features(feats, forest(label, trees, depth, strategy, weight, seed)).fit(df)


def fit_boosted(df: DataFrame, feats, label: str, depth: int = 6, rate: float = 0.1, rounds: int = 100, classes: int = 2, seed: int = 42) -> PipelineModel:
    """Gradient boosted trees; more than two classes go one against the rest (one model for all: `boosting`)."""
    set_checkpoints(df.sparkSession)  # else the scores of a round carry the lineage of all rounds before
    gbt = GBTClassifier(labelCol=label, maxDepth=depth, stepSize=rate, maxIter=rounds, seed=seed)
    return with_features(feats, gbt if classes == 2 else OneVsRest(labelCol=label, classifier=gbt)).fit(df)


def fit_svc(df: DataFrame, feats, label: str, C: float = 1.0, rounds: int = 100) -> PipelineModel:
    """Linear support vector classifier; the kernel form needs an n x n matrix."""
    svc = LinearSVC(labelCol=label, regParam=1.0 / (C * df.count()), standardization=False, maxIter=rounds)
    return with_features(feats, svc).fit(df)


def fit_mlp(df: DataFrame, feats, label: str, layers: Sequence[int], seed: int = 42, rounds: int = 100) -> PipelineModel:
    """`layers` from input width to class count, for example [64, 100, 10]."""
    return with_features(feats, MultilayerPerceptronClassifier(labelCol=label, layers=list(layers), maxIter=rounds, seed=seed)).fit(df)


def knn_classify(train: DataFrame, test: DataFrame, key: str, feats: str, label: str, k: int = 5, out: str = "prediction") -> DataFrame:
    """(key, prediction): the most frequent label among the k nearest training rows, smallest on a tie."""
    near = nearest(test, train, key, feats, k)
    labels = train.select(F.col(key).alias("neighbor"), F.col(label).alias("_y"))
    votes = near.join(labels, "neighbor").groupBy(key, "_y").agg(F.count("*").alias("n"))
    return votes.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), "_y")).alias("b")).select(key, F.col("b._y").alias(out))
