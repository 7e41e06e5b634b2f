"""Cross validation, sweeps, and importance by permutation."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from larkspur.operators.ordered import hash_rank


def evaluator(metric: str, label: str):
    """accuracy, recall, f1, roc_auc, neg_mse, neg_mae or r2."""
    if metric == "roc_auc":
        return BinaryClassificationEvaluator(labelCol=label)
    names = {"accuracy": "accuracy", "recall": "weightedRecall", "precision": "weightedPrecision", "f1": "f1"}
    if metric in names:
        return MulticlassClassificationEvaluator(labelCol=label, metricName=names[metric])
    return RegressionEvaluator(labelCol=label, metricName={"neg_mse": "mse", "neg_mae": "mae", "r2": "r2"}[metric])


def param_grid(grid: Mapping) -> list:
    b = ParamGridBuilder()
    for p, values in grid.items():
        b = b.addGrid(p, list(values))
    return b.build()


def grid_search(df: DataFrame, est: Estimator, grid: Mapping, fold: str, folds: int, metric: str, label: str, parallelism: int = 4) -> CrossValidatorModel:
    """Fit every parameter set on every fold; the best one is refitted on all rows."""
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=param_grid(grid), evaluator=evaluator(metric, label), numFolds=folds, foldCol=fold, parallelism=parallelism
    )
    return cv.fit(df)


def grid_table(model: CrossValidatorModel, spark) -> DataFrame:
    """(params, mean, std), best first by the sense of the metric."""
    rows = []
    for params, mean, std in zip(model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics):
        name = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name))
        rows.append((name, float(mean), float(std)))
    up = model.getEvaluator().isLargerBetter()
    return spark.createDataFrame(rows, "params string, mean double, std double").orderBy(F.desc("mean") if up else F.asc("mean"), "params")


def cv_scores(df: DataFrame, est: Estimator, fold: str, folds: int, metric: str, label: str) -> DataFrame:
    """(fold, score); errors are negative for the `neg_` metrics."""
    ev, sign, rows = evaluator(metric, label), -1.0 if metric.startswith("neg_") else 1.0, []
    for f in range(folds):
        model = est.fit(df.where(F.col(fold) != f))
        rows.append((f, sign * float(ev.evaluate(model.transform(df.where(F.col(fold) == f))))))
    return df.sparkSession.createDataFrame(rows, "fold int, score double")


def cv_predict(df: DataFrame, est: Estimator, fold: str, folds: int, out: str = "prediction") -> DataFrame:
    """Every row once, predicted by the model that did not see its fold."""
    keep, res = df.columns, None
    for f in range(folds):
        model = est.fit(df.where(F.col(fold) != f))
        part = model.transform(df.where(F.col(fold) == f)).select(*keep, F.col("prediction").alias(out))
        res = part if res is None else res.unionByName(part)
    return res


def sweep(fit: Callable[[object], object], test: DataFrame, values: Sequence, metric: str, label: str, name: str = "value") -> DataFrame:
    """(value, score) of `fit(value)` on held-out rows."""
    ev = evaluator(metric, label)
    rows = [(float(v), float(ev.evaluate(fit(v).transform(test)))) for v in values]
    return test.sparkSession.createDataFrame(rows, f"{name} double, score double")


def sweep_forest(train: DataFrame, test: DataFrame, feats, label: str, sizes: Sequence[int], strategies: Sequence[str], depth: int = 5, seed: int = 42) -> DataFrame:
    """(strategy, trees, error) on held-out rows, as Spark keeps no out-of-bag score. One forest of the largest
    size is fitted per strategy; a smaller size is its first trees."""
    from larkspur.models.classifiers import fit_forest

    out, want = None, sorted(set(sizes))
    train, test = train.cache(), test.cache()

    def score(batches):
        for b in batches:
            votes = np.cumsum(np.stack([np.stack(x) for x in b["votes"]]), axis=1)[:, np.array(want) - 1]
            miss = (np.argmax(votes, axis=2) != b["y"].to_numpy()[:, None]).sum(axis=0)
            yield pd.DataFrame({"trees": want, "miss": miss, "rows": len(b)})

    for s in strategies:
        model = fit_forest(train, feats, label, want[-1], depth, s, seed=seed)
        votes = _tree_votes(model, test).select(F.col(label).cast("double").alias("y"), "votes")
        sums = votes.mapInPandas(score, "trees int, miss long, rows long").groupBy("trees").agg((F.sum("miss") / F.sum("rows")).alias("error"))
        part = sums.select(F.lit(s).alias("strategy"), "trees", "error")
        out = part if out is None else out.unionByName(part)
    return out


def _tree_votes(model, df: DataFrame) -> DataFrame:
    """`df` and, per row, the class shares that each tree of the forest votes with."""
    *before, forest = model.stages
    for m in before:
        df = m.transform(df)
    names = [f"_t{i}" for i in range(forest.getNumTrees)]
    for name, tree in zip(names, forest.trees):
        df = tree.setFeaturesCol(forest.getFeaturesCol()).setProbabilityCol(name).setRawPredictionCol("").setPredictionCol("").transform(df)
    return df.withColumn("votes", F.array(*[vector_to_array(n) for n in names])).drop(*names)


# ---- elastic-net path from one pass over the rows ----


def gram(df: DataFrame, feats: Sequence[str], y: str, fold: str) -> dict[int, np.ndarray]:
    """Per fold the matrix Z'Z of Z = (1, x, y). Every task adds up its rows in numpy and sends one
    matrix per fold; p columns cost (p + 2)^2 numbers, whatever the row count. Rows with a null or NaN are left out."""
    width = len(feats) + 2
    src = df.select(F.col(fold).cast("int").alias("fold"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(feats)], F.col(y).cast("double").alias("y")).dropna()

    def add(batches):
        sums = {}
        for b in batches:
            for f, rows in b.groupby("fold"):
                z = np.column_stack([np.ones(len(rows)), rows.drop(columns="fold").to_numpy()])
                sums[f] = sums.get(f, 0) + z.T @ z
        for f, m in sums.items():
            yield pd.DataFrame({"fold": f, "i": np.arange(width * width), "s": m.ravel()})

    cells = src.mapInPandas(add, "fold int, i int, s double").groupBy("fold", "i").agg(F.sum("s").alias("s")).collect()
    out = {}
    for r in cells:
        out.setdefault(r["fold"], np.zeros(width * width))[r["i"]] = r["s"]
    return {f: m.reshape(width, width) for f, m in out.items()}


def _moments(g: np.ndarray) -> tuple:
    n = g[0, 0]
    mean = g[0, 1:] / n
    cov = g[1:, 1:] / n - np.outer(mean, mean)
    return n, mean, cov


def _descend(xx: np.ndarray, xy: np.ndarray, alpha: float, l1: float, w: np.ndarray, rounds: int = 1000, tol: float = 1e-8) -> np.ndarray:
    for _ in range(rounds):
        before = w.copy()
        for j in range(len(w)):
            rho = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0.0) / (xx[j, j] + alpha * (1 - l1)) if xx[j, j] + alpha * (1 - l1) else 0.0
        if np.abs(w - before).max() <= tol * max(1.0, np.abs(w).max()):
            break
    else:
        warnings.warn(f"coordinate descent hadn't settled after {rounds} rounds (alpha {alpha}, l1 {l1})", stacklevel=2)
    return w


def elastic_net_path(grams: Mapping[int, np.ndarray], l1s: Sequence[float], alphas: Sequence[float]) -> list[tuple]:
    """(l1, alpha, mean squared error over the folds) with features standardized on each training part.
    Works on the (p + 2)^2 sums only."""
    total, res = sum(grams.values()), []
    for l1 in l1s:
        errors = np.zeros((len(grams), len(alphas)))
        for fi, f in enumerate(sorted(grams)):
            _, mean, cov = _moments(total - grams[f])
            sd = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
            sd[sd == 0] = 1.0
            xx, xy = cov[:-1, :-1] / np.outer(sd, sd), cov[:-1, -1] / sd
            w = np.zeros(len(sd))
            for a in sorted(alphas, reverse=True):  # warm start from the stronger penalty
                w = _descend(xx, xy, a, l1, w)
                beta = w / sd
                full = np.concatenate([[mean[-1] - beta @ mean[:-1]], beta])
                g = grams[f]
                sq = g[-1, -1] - 2 * full @ g[:-1, -1] + full @ g[:-1, :-1] @ full
                errors[fi, list(alphas).index(a)] = sq / g[0, 0]
        res += [(float(l1), float(a), float(e)) for a, e in zip(alphas, errors.mean(0))]
    return res


def fit_elastic_net_moments(df: DataFrame, feats: Sequence[str], y: str, alpha: float, l1_ratio: float) -> DataFrame:
    """(feature, coefficient) of the elastic net on columns as they come, the intercept last: mean squared error / 2 +
    alpha * (l1_ratio * |w| + (1 - l1_ratio) / 2 * |w|^2). One read of the rows; the descent runs on their sums to the
    last digits, where a solver that reads the rows in every step stops early."""
    sums = gram(df.withColumn("_fold", F.lit(0)), feats, y, "_fold")
    if not sums:
        raise ValueError("no rows to learn from")
    _, mean, cov = _moments(sums[0])
    w = _descend(cov[:-1, :-1], cov[:-1, -1], alpha, l1_ratio, np.zeros(len(feats)), rounds=20_000, tol=1e-13)
    rows = [*zip(feats, w.tolist()), ("intercept", float(mean[-1] - w @ mean[:-1]))]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def elastic_net_cv(df: DataFrame, feats: Sequence[str], y: str, fold: str, l1s: Sequence[float], alphas: Sequence[float]) -> DataFrame:
    """(l1_ratio, alpha, mse), best first."""
    rows = elastic_net_path(gram(df, feats, y, fold), l1s, alphas)
    return df.sparkSession.createDataFrame(rows, "l1_ratio double, alpha double, mse double").orderBy("mse", "l1_ratio", "alpha")


def permutation_importance(model, df: DataFrame, key: str, cols: Sequence[str], metric: str, label: str, seed: int = 42) -> DataFrame:
    """(feature, drop): loss of score when one column is shuffled. The shuffle joins two hash orders of
    the same rows on their rank, so it is repeatable and spread over all tasks."""
    ev = evaluator(metric, label)
    sign = 1.0 if ev.isLargerBetter() else -1.0
    base = ev.evaluate(model.transform(df))
    ranked = hash_rank(df, key, seed, out="_slot")
    rows = []
    for i, c in enumerate(cols):
        other = hash_rank(df.select(key, c), key, f"{seed}/{i}", out="_slot").select("_slot", c)
        mixed = ranked.drop(c).join(other, "_slot").drop("_slot")
        rows.append((c, sign * float(base - ev.evaluate(model.transform(mixed)))))
    return df.sparkSession.createDataFrame(rows, "feature string, drop double").orderBy(F.desc("drop"), "feature")
