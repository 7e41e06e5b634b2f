"""Naive Bayes as aggregates: a fit is a table of counts, a score is joins and sums."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.session import settle

CLASS_LIMIT = 1000


@dataclass
class NaiveBayes:
    """`classes` in sorted order, `sizes` their row counts, `table` the long table of log probabilities."""

    classes: list
    sizes: list
    alpha: float
    table: DataFrame
    columns: list | None = None

    @property
    def log_priors(self) -> list[float]:
        total = sum(self.sizes)
        return [math.log(n / total) for n in self.sizes]

    def priors(self) -> DataFrame:
        rows = [(k, int(n), p) for k, n, p in zip(self.classes, self.sizes, self.log_priors)]
        kind = "string" if isinstance(self.classes[0], str) else "bigint"
        return self.table.sparkSession.createDataFrame(rows, f"class {kind}, n bigint, log_prior double")


def _classes(df: DataFrame, label: str) -> tuple[list, list]:
    rows = df.groupBy(label).agg(F.count("*").alias("n")).limit(CLASS_LIMIT + 1).collect()
    if len(rows) > CLASS_LIMIT:
        raise ValueError(f"{label} has more than {CLASS_LIMIT} classes")
    rows = sorted(((r[0], r[1]) for r in rows))
    return [k for k, _ in rows], [n for _, n in rows]


def _by_class(classes: list, values: Sequence[Column]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("class"), v.alias("n")) for k, v in zip(classes, values)])


def _best(scores: Sequence[Column], classes: list) -> Column:
    """The class of the largest score, the first one on a tie."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    pick = F
    for s, k in zip(scores, classes):
        pick = pick.when(s == top, F.lit(k))
    return pick


def fit_categorical_nb(df: DataFrame, cols: Sequence[str], label: str, alpha: float = 1.0) -> NaiveBayes:
    """Table (column, value, class, n, log_prob) with ln((n + alpha) / (N + alpha K)); unseen pairs have n = 0."""
    classes, sizes = _classes(df, label)
    src = df.select(F.col(label).alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols])
    long = src.unpivot(["_y"], list(cols), "column", "value").where("value is not null")
    counts = long.groupBy("column", "value").agg(
        *[F.count_if(F.col("_y") == F.lit(k)).alias(f"n{i}") for i, k in enumerate(classes)]
    )
    widths = counts.groupBy("column").agg(F.count("*").alias("_k"))
    # N counts the rows of the class in which the column is present
    present = counts.groupBy("column").agg(*[F.sum(f"n{i}").alias(f"t{i}") for i in range(len(classes))])
    cells = [
        F.struct(
            F.lit(k).alias("class"),
            F.col(f"n{i}").alias("n"),
            F.log((F.col(f"n{i}") + alpha) / (F.col(f"t{i}") + alpha * F.col("_k"))).alias("log_prob"),
            F.log(alpha / (F.col(f"t{i}") + alpha * F.col("_k"))).alias("log_unseen"),
        )
        for i, k in enumerate(classes)
    ]
    table = counts.join(widths, "column").join(present, "column").select("column", "value", F.inline(F.array(*cells)))
    return NaiveBayes(classes, sizes, alpha, settle(table), list(cols))


def predict_categorical_nb(df: DataFrame, model: NaiveBayes, out: str = "prediction", scores: str | None = None) -> DataFrame:
    """One left join per feature to its small table of class scores; a row never fans out."""
    k = len(model.classes)
    total = [F.lit(p) for p in model.log_priors]
    unseen = {
        (r["column"], r["class"]): r["u"]
        for r in model.table.groupBy("column", "class").agg(F.max("log_unseen").alias("u")).collect()
    }
    for j, c in enumerate(model.columns):
        wide = model.table.where(F.col("column") == c).groupBy(F.col("value").alias(f"_v{j}")).agg(
            *[F.max(F.when(F.col("class") == F.lit(cl), F.col("log_prob"))).alias(f"_p{j}_{i}") for i, cl in enumerate(model.classes)]
        )
        df = df.join(wide, F.col(c).cast("string") == F.col(f"_v{j}"), "left").drop(f"_v{j}")
        for i, cl in enumerate(model.classes):
            miss = F.when(F.col(c).isNull(), F.lit(0.0)).otherwise(F.lit(unseen[(c, cl)]))
            total[i] = total[i] + F.coalesce(F.col(f"_p{j}_{i}"), miss)
    df = df.withColumns({f"_s{i}": total[i] for i in range(k)})
    df = df.withColumn(out, _best([F.col(f"_s{i}") for i in range(k)], model.classes))
    if scores:
        df = df.withColumn(scores, F.array(*[f"_s{i}" for i in range(k)]))
    return df.drop(*[f"_s{i}" for i in range(k)], *[f"_p{j}_{i}" for j in range(len(model.columns)) for i in range(k)])


def nb_table(model: NaiveBayes) -> DataFrame:
    """Probability by feature, category and class."""
    return model.table.withColumn("prob", F.exp("log_prob"))


def discriminative(table: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(class, column) with one category above the threshold and another below 1 - threshold."""
    spread = table.groupBy("class", "column").agg(
        F.max("prob").alias("max_prob"), F.min("prob").alias("min_prob"), F.count("*").alias("_k")
    )
    hit = (F.col("_k") > 1) & (F.col("max_prob") > threshold) & (F.col("min_prob") < 1 - threshold)
    return spread.where(hit).drop("_k")


def fit_multinomial_nb(terms: DataFrame, labels: DataFrame, key: str, label: str, alpha: float = 1.0, weight: str = "tf") -> NaiveBayes:
    """Table (term, class, total, log_prob) from (key, term, weight) and (key, label); priors are plain shares."""
    classes, sizes = _classes(labels, label)
    joined = terms.join(labels.select(key, F.col(label).alias("class")), key)
    return multinomial_from_counts(joined.select("term", "class", F.col(weight).alias("n")), classes, sizes, alpha)


def multinomial_from_counts(counts: DataFrame, classes: list, sizes: list, alpha: float = 1.0) -> NaiveBayes:
    """The model of sufficient statistics: weights `n` per (term, class), one row or several, and rows per class."""
    sums = counts.groupBy("term").agg(
        *[F.sum(F.when(F.col("class") == F.lit(k), F.col("n")).otherwise(F.lit(0))).alias(f"n{i}") for i, k in enumerate(classes)]
    )
    whole = sums.agg(F.struct(F.count("*").alias("v"), *[F.sum(f"n{i}").alias(f"t{i}") for i in range(len(classes))])).scalar()
    cells = [
        F.struct(
            F.lit(k).alias("class"),
            F.col(f"n{i}").alias("total"),
            F.log((F.col(f"n{i}") + alpha) / (whole.getField(f"t{i}") + alpha * whole.getField("v"))).alias("log_prob"),
        )
        for i, k in enumerate(classes)
    ]
    return NaiveBayes(classes, sizes, alpha, settle(sums.select("term", F.inline(F.array(*cells)))))


def predict_multinomial_nb(terms: DataFrame, docs: DataFrame, key: str, model: NaiveBayes, weight: str = "tf", out: str = "prediction") -> DataFrame:
    """Class and log score per document; words outside the vocabulary are skipped, a document without
    known words gets the prior."""
    k = len(model.classes)
    wide = model.table.groupBy("term").agg(
        *[F.max(F.when(F.col("class") == F.lit(c), F.col("log_prob"))).alias(f"_p{i}") for i, c in enumerate(model.classes)]
    )
    sums = terms.join(wide, "term").groupBy(key).agg(*[F.sum(F.col(weight) * F.col(f"_p{i}")).alias(f"_s{i}") for i in range(k)])
    joined = docs.join(sums, key, "left")
    joined = joined.withColumns({f"_s{i}": F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + F.lit(p) for i, p in enumerate(model.log_priors)})
    joined = joined.withColumn(out, _best([F.col(f"_s{i}") for i in range(k)], model.classes))
    return joined.withColumn("scores", F.array(*[f"_s{i}" for i in range(k)])).drop(*[f"_s{i}" for i in range(k)])


def nb_top_terms(model: NaiveBayes, n: int = 20) -> DataFrame:
    """Words of the highest probability per class."""
    probs = model.table.select("class", "term", F.exp("log_prob").alias("prob"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("prob"), "term"))
    return probs.withColumn("rank", rank).where(F.col("rank") <= n)


def fit_gaussian_nb(df: DataFrame, feats: Sequence[str], label: str, smoothing: float = 1e-9) -> NaiveBayes:
    """Table (class, column, mean, var); every variance grows by smoothing times the largest overall variance."""
    classes, sizes = _classes(df, label)
    widest = df.agg(F.greatest(*[F.var_pop(c) for c in feats], F.lit(0.0))).scalar()
    cells = [F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.var_pop(c).alias("var")) for c in feats]
    table = df.groupBy(F.col(label).alias("class")).agg(F.array(*cells).alias("x")).select("class", F.inline("x"))
    table = table.withColumn("var", F.col("var") + F.lit(smoothing) * widest)
    return NaiveBayes(classes, sizes, smoothing, table, list(feats))


def predict_gaussian_nb(df: DataFrame, model: NaiveBayes, out: str = "prediction") -> DataFrame:
    params = {(r["class"], r["column"]): (r["mean"], r["var"]) for r in model.table.collect()}
    scores = []
    for k, prior in zip(model.classes, model.log_priors):
        total = F.lit(prior)
        for c in model.columns:
            mean, var = params[(k, c)]
            total = total - (math.log(2 * math.pi * var) / 2) - F.pow(F.col(c) - mean, F.lit(2)) / (2 * var)
        scores.append(total)
    df = df.withColumns({f"_s{i}": s for i, s in enumerate(scores)})
    names = [f"_s{i}" for i in range(len(scores))]
    return df.withColumn(out, _best([F.col(n) for n in names], model.classes)).drop(*names)
