"""Models made of models: boosting by weights, stacking, a committee on bootstrap samples."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from larkspur.models.linear import with_features
from larkspur.operators.split import bootstrap, bootstrap_columns
from larkspur.session import settle

EXTRA = ["rawPrediction", "probability", "prediction"]


def _plain(model, df: DataFrame, out: str) -> DataFrame:
    """Predictions in column `out`, the model's other columns dropped."""
    keep = df.columns
    return model.transform(df).select(*keep, F.col("prediction").alias(out))


@dataclass
class AdaBoost:
    classes: list
    members: list = field(default_factory=list)  # (weight, model)

    def transform(self, df: DataFrame) -> DataFrame:
        keep = df.columns
        for i, (_, m) in enumerate(self.members):
            df = _plain(m, df, f"_p{i}")
        votes = [
            sum((F.when(F.col(f"_p{i}") == float(k), w).otherwise(0.0) for i, (w, _) in enumerate(self.members)), F.lit(0.0))
            for k in self.classes
        ]
        df = df.withColumn("_v", F.array(*votes))
        pick = F.element_at(F.array(*[F.lit(float(k)) for k in self.classes]), F.array_position("_v", F.array_max("_v")).cast("int"))
        return df.select(*keep, pick.alias("prediction"))


def fit_adaboost(df: DataFrame, base: Estimator, label: str, rounds: int = 50, rate: float = 1.0, cut_every: int = 5) -> AdaBoost:
    """SAMME with any estimator that takes a weight column (naive Bayes, stumps). One aggregate per
    round gives the weighted error; weights are checkpointed every few rounds."""
    classes = sorted(r[0] for r in df.select(label).distinct().collect())
    out = AdaBoost(classes)
    cur = settle(df.withColumn("_w", F.lit(1.0)))
    base = base.copy().setLabelCol(label).setWeightCol("_w")
    for i in range(rounds):
        model = base.fit(cur)
        scored = _plain(model, cur, "_p").withColumn("_miss", (F.col("_p") != F.col(label)).cast("double"))
        got = scored.agg(F.sum(F.col("_w") * F.col("_miss")), F.sum("_w")).first()
        err = got[0] / got[1]
        if err >= 1 - 1 / len(classes):
            break
        weight = rate * (math.log((1 - err) / max(err, 1e-12)) + math.log(len(classes) - 1))
        out.members.append((weight, model))
        if err <= 0:
            break
        # weights are kept near 1 on average, so long runs neither vanish nor overflow
        scale = (got[1] - got[0] + got[0] * math.exp(weight)) / got[1]
        cur = scored.withColumn("_w", F.col("_w") * F.exp(F.lit(weight) * F.col("_miss")) / F.lit(scale)).drop("_p", "_miss")
        if (i + 1) % cut_every == 0:
            cur = settle(cur)
    if not out.members:
        raise ValueError("the base estimator is no better than chance")
    return out


@dataclass
class Stack:
    bases: list
    meta: object

    def transform(self, df: DataFrame) -> DataFrame:
        keep = df.columns
        for i, m in enumerate(self.bases):
            df = _plain(m, df, f"_b{i}")
        return _plain(self.meta, df, "_stacked").select(*keep, F.col("_stacked").alias("prediction"))


def fit_stack(df: DataFrame, bases: Sequence[Estimator], label: str, fold: str, folds: int, meta: Estimator | None = None) -> Stack:
    """Meta model on out-of-fold predictions of the bases, so no base scores a row it was fitted on; the
    bases kept for scoring are refitted on all rows."""
    parts = None
    for f in range(folds):
        held = df.where(F.col(fold) == f)
        train = df.where(F.col(fold) != f)
        for i, b in enumerate(bases):
            held = _plain(b.fit(train), held, f"_b{i}")
        parts = held if parts is None else parts.unionByName(held)
    parts = settle(parts)
    meta = meta or RandomForestClassifier(labelCol=label, seed=7)
    model = with_features([f"_b{i}" for i in range(len(bases))], meta)
    # the meta features get a name of their own beside the features of the bases
    model.getStages()[0].setOutputCol("_meta")
    model.getStages()[1].setFeaturesCol("_meta")
    return Stack([b.fit(df) for b in bases], model.fit(parts))


@dataclass
class Committee:
    members: list  # (columns, model)
    meta: object

    def votes(self, df: DataFrame) -> DataFrame:
        for i, (cols, m) in enumerate(self.members):
            df = _plain(m, VectorAssembler(inputCols=cols, outputCol=f"_x{i}").transform(df), f"_v{i}").drop(f"_x{i}")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        keep = df.columns
        return self.meta.transform(self.votes(df)).select(*keep, "prediction")


def fit_committee(
    df: DataFrame, key: str, feats: Sequence[str], label: str, base: Estimator, n: int = 30, rows: int = 8166, redraw: int = 5444,
    col_share: float = 0.64, holdout: DataFrame | None = None, meta: Estimator | None = None, seed: int = 42,
) -> Committee:
    """Each member sees `rows` drawn rows plus `redraw` drawn again, and a draw of the columns, which it
    keeps for scoring. The meta model learns on the members' votes over `holdout`."""
    members = []
    for i in range(n):
        cols = bootstrap_columns(feats, col_share, seed + i)
        drawn = bootstrap(df, key, rows, seed + i, redraw)
        block = VectorAssembler(inputCols=cols, outputCol=f"_x{i}").transform(drawn)
        members.append((cols, base.copy().setLabelCol(label).setFeaturesCol(f"_x{i}").fit(block)))
    out = Committee(members, None)
    voted = settle(out.votes(df if holdout is None else holdout))
    meta = meta or RandomForestClassifier(labelCol=label, bootstrap=False, seed=seed)
    names = [f"_v{i}" for i in range(n)]
    pipe = with_features(names, meta)
    pipe.getStages()[0].setOutputCol("_votes")
    pipe.getStages()[1].setFeaturesCol("_votes")
    out.meta = pipe.fit(voted)
    return out
