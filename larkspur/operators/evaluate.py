"""Evaluation. Input is a prediction table (label, prediction[, score]); nothing but counts leaves the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.operators.ordered import running_sums, value_borders, bin_count

CLUSTER_LIMIT = 10_000


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / F.nullif(b, F.lit(0)))


def _cells(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows predicted right, of those with both a label and a prediction."""
    return pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion(pred: DataFrame, classes: Sequence = (), label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A row for every pair of classes, zeros kept. The classes are those of the data, as label or as prediction,
    and any listed in `classes`; a null label or prediction is counted where it occurs, but not paired at zero."""
    cells = _cells(pred, label, prediction)
    seen = cells.agg(F.array_union(F.collect_set("label"), F.collect_set("prediction")).alias("all"))
    if classes:
        seen = seen.select(F.array_union("all", F.array(*[F.lit(c) for c in classes])).alias("all"))
    pairs = seen.select("all", F.explode("all").alias("label")).select("label", F.explode("all").alias("prediction"), F.lit(0).cast("bigint").alias("n"))
    return pairs.unionByName(cells).groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def _per_class(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    c = _cells(pred, label, prediction)
    # each cell counts once as true class and once as predicted class
    sides = c.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed"), F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    k = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("tp").alias("tp"))
    p, r = _ratio(F.col("tp"), F.col("claimed")), _ratio(F.col("tp"), F.col("support"))
    k = k.withColumn("precision", p).withColumn("recall", r)
    return k.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def class_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and weighted means."""
    k = _per_class(pred, label, prediction)
    names = ["precision", "recall", "f1"]
    rows = k.select(F.col("class").cast("string").alias("class"), *names, "support")
    macro = k.agg(*[F.avg(n).alias(n) for n in names], F.sum("support").alias("support")).select(F.lit("macro avg").alias("class"), *names, "support")
    weighted = k.agg(*[_ratio(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(n) for n in names], F.sum("support").alias("support"))
    return rows.unionByName(macro).unionByName(weighted.select(F.lit("weighted avg").alias("class"), *names, "support"))


def averaged_scores(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per averaging: macro, micro, weighted."""
    k = _per_class(pred, label, prediction)
    names = ["precision", "recall", "f1"]
    micro = _ratio(F.sum("tp"), F.sum("support"))
    wide = k.agg(
        F.struct(F.lit("macro").alias("average"), *[F.avg(n).alias(n) for n in names]).alias("a"),
        F.struct(F.lit("micro").alias("average"), *[micro.alias(n) for n in names]).alias("b"),
        F.struct(F.lit("weighted").alias("average"), *[_ratio(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(n) for n in names]).alias("c"),
    )
    return wide.select(F.inline(F.array("a", "b", "c")))


def _score_counts(pred: DataFrame, score: str, positive, label: str) -> DataFrame:
    hit = F.col(label) == F.lit(positive)
    return pred.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")
    )


def _score_borders(pred: DataFrame, score: str) -> list:
    return value_borders(pred.select(F.col(score).cast("double").alias("score")), ["score"], bin_count(pred))["score"]


def roc_points(pred: DataFrame, score: str = "score", positive=1, label: str = "label") -> DataFrame:
    """(score, tpr, fpr) per distinct score, from the highest down."""
    counts = _score_counts(pred, score, positive, label)
    sums = running_sums(counts, [], "score", ["pos", "neg"], _score_borders(pred, score), descending=True)
    total = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    return sums.select(
        "score",
        _ratio(F.col("cum_pos"), total.getField("p")).alias("tpr"),
        _ratio(F.col("cum_neg"), total.getField("n")).alias("fpr"),
    )


def roc_by_class(pred: DataFrame, scores: Mapping, label: str = "label") -> DataFrame:
    """ROC points of every class against the rest; `scores` maps class to its score column."""
    out = None
    for k, col in scores.items():
        part = roc_points(pred, col, k, label).withColumn("class", F.lit(str(k)))
        out = part if out is None else out.unionByName(part)
    return out


def auc(pred: DataFrame, score: str = "score", positive=1, label: str = "label") -> DataFrame:
    """Rank sum: every positive beats the negatives below it, and half of those level with it."""
    counts = _score_counts(pred, score, positive, label)
    sums = running_sums(counts, [], "score", ["neg"], _score_borders(pred, score))
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    return sums.agg((wins / (F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"))


def auc_ovr(pred: DataFrame, scores: Mapping, label: str = "label") -> DataFrame:
    """Mean over classes of the one-against-rest AUC."""
    out = None
    for k, col in scores.items():
        part = auc(pred, col, k, label)
        out = part if out is None else out.unionByName(part)
    return out.agg(F.avg("auc").alias("auc"))


def error_counts(pred: DataFrame, positive, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label) == F.lit(positive), F.col(prediction) == F.lit(positive)
    return pred.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn")
    )


def sensitivity_specificity(pred: DataFrame, positive, label: str = "label", prediction: str = "prediction") -> DataFrame:
    e = error_counts(pred, positive, label, prediction)
    return e.select(
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("sensitivity"), _ratio(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity")
    )


def detection_rates(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: share of its rows detected, and share of its predictions that are right."""
    k = _per_class(pred, label, prediction)
    return k.select("class", F.col("recall").alias("detected"), F.col("precision").alias("right"))


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction", inverse=None) -> DataFrame:
    """MAE, MSE and R2; `inverse` is a column function (say `F.expm1`) put on both sides first."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    if inverse is not None:
        y, p = inverse(y), inverse(p)
    sq = F.pow(y - p, F.lit(2))
    return pred.agg(
        F.avg(F.abs(y - p)).alias("mae"), F.avg(sq).alias("mse"), (1 - F.sum(sq) / (F.var_pop(y) * F.count(y))).alias("r2")
    )


def residuals(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.withColumn("residual", F.col(label) - F.col(prediction))


def score_as_class(pred: DataFrame, threshold: float, score: str = "prediction", out: str = "prediction") -> DataFrame:
    """1 where a linear score exceeds the threshold, else 0."""
    return pred.withColumn(out, (F.col(score) > threshold).cast("int"))


def route_by_score(df: DataFrame, score: str, hi: float = 0.95, lo: float = 0.80, out: str = "route") -> DataFrame:
    route = F.when(F.col(score) >= hi, "spam").when(F.col(score) >= lo, "review").otherwise("inbox")
    return df.withColumn(out, route)


def score_distribution(scores: DataFrame, bins: int, score: str = "score") -> DataFrame:
    """Histogram of repeated scores with mean, std, min and max on every row."""
    from larkspur.operators.profile import histogram

    s = scores.agg(F.struct(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max"))).scalar()
    return histogram(scores, score, bins).select("bin", "n", *[s.getField(n).alias(n) for n in ("mean", "std", "min", "max")])


def compare_models(preds: Mapping[str, DataFrame], positive, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per model: accuracy, precision, recall, F1 of the positive class."""
    out = None
    for name, pred in preds.items():
        e = error_counts(pred, positive, label, prediction)
        p, r = _ratio(F.col("tp"), F.col("tp") + F.col("fp")), _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
        row = e.select(
            F.lit(name).alias("model"),
            _ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("accuracy"),
            p.alias("precision"),
            r.alias("recall"),
            _ratio(2 * p * r, p + r).alias("f1"),
        )
        out = row if out is None else out.unionByName(row)
    return out


# ---- clusters ----


def adjusted_rand(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """From pair counts on the contingency table."""
    cells = df.groupBy(F.col(label).alias("a"), F.col(cluster).alias("b")).agg(F.count("*").alias("n"))

    def pairs(col) -> Column:
        col = col.cast("double")
        return F.sum(col * (col - 1) / 2)

    both = cells.agg(pairs(F.col("n"))).scalar()
    by_a = cells.groupBy("a").agg(F.sum("n").alias("n")).agg(pairs(F.col("n"))).scalar()
    by_b = cells.groupBy("b").agg(F.sum("n").alias("n")).agg(pairs(F.col("n"))).scalar()
    total = cells.agg(F.sum("n").cast("double").alias("n"))
    all_pairs = F.col("n") * (F.col("n") - 1) / 2
    expected = by_a * by_b / all_pairs
    top = (by_a + by_b) / 2
    return total.select(F.when(top == expected, F.lit(1.0)).otherwise((both - expected) / (top - expected)).alias("ari"))


def cluster_purity(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Per cluster: size, its most frequent label (smallest on a tie) and that label's share."""
    cells = df.groupBy(cluster, label).agg(F.count("*").alias("n"))
    best = cells.groupBy(cluster).agg(F.sum("n").alias("size"), F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("l"))).alias("b"))
    return best.select(cluster, "size", F.col("b.l").alias("top_label"), (-F.col("b.n") / F.col("size")).alias("purity"))


def cluster_sizes(df: DataFrame, cluster: str, noise: int = -1) -> DataFrame:
    """Rows per cluster, and whether the cluster is the noise."""
    return df.groupBy(cluster).agg(F.count("*").alias("n")).withColumn("is_noise", (F.col(cluster) == noise).cast("int"))


def _as_array(df: DataFrame, feats: str) -> Column:
    return vector_to_array(feats) if df.schema[feats].dataType.typeName() == "vectorudt" else F.col(feats).cast("array<double>")


def _cluster_sums(pts: DataFrame) -> DataFrame:
    """Per cluster: size, sum of squared norms, and the sum vector (by position, so partial sums combine)."""
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    sizes = pts.groupBy("c").agg(F.count("*").alias("n"), F.sum(norm).alias("psi"))
    axes = pts.select("c", F.posexplode("v").alias("i", "x")).groupBy("c", "i").agg(F.sum("x").alias("s"))
    sums = axes.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda t: t["s"]).alias("s"))
    return sizes.join(sums, "c")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def inertia(df: DataFrame, feats: str, cluster: str) -> DataFrame:
    """Sum of squared distances to the own cluster's mean: psi - |s|^2 / n per cluster."""
    sums = _cluster_sums(df.select(F.col(cluster).alias("c"), _as_array(df, feats).alias("v")))
    return sums.agg(F.sum(F.col("psi") - _dot(F.col("s"), F.col("s")) / F.col("n")).alias("inertia"))


def silhouette(df: DataFrame, feats: str, cluster: str, noise: int | None = None) -> DataFrame:
    """Mean silhouette with squared distances, in closed form from one sum vector per cluster: the mean
    squared distance of x to a cluster is |x|^2 + psi/n - 2 x.s/n. One row is scored against k clusters
    without meeting any other row. `noise` names a cluster to leave out."""
    pts = df.select(F.col(cluster).alias("c"), _as_array(df, feats).alias("v"))
    if noise is not None:
        pts = pts.where(F.col("c") != noise)
    sums = _cluster_sums(pts)
    many = F.count("*") > CLUSTER_LIMIT
    stop = F.raise_error(F.lit(f"silhouette holds one vector per cluster; more than {CLUSTER_LIMIT} clusters"))
    table = F.collect_list(F.struct("c", "n", "psi", "s"))
    k = sums.limit(CLUSTER_LIMIT + 1).agg(F.when(many, stop.cast("string")).alias("e"), table.alias("t")).select(
        F.when(F.col("e").isNull(), F.col("t"))
    ).scalar()
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    rows = pts.withColumn("k", k).withColumn("x2", norm)
    far = F.transform(
        "k",
        lambda t: F.struct(
            t["c"].alias("c"), t["n"].alias("n"), (F.col("x2") + t["psi"] / t["n"] - 2 * _dot(F.col("v"), t["s"]) / t["n"]).alias("d")
        ),
    )
    rows = rows.withColumn("far", far)
    own = F.filter("far", lambda t: t["c"] == F.col("c"))[0]
    other = F.array_min(F.transform(F.filter("far", lambda t: t["c"] != F.col("c")), lambda t: t["d"]))
    rows = rows.select(own["n"].alias("n"), (own["d"] * own["n"] / F.nullif(own["n"] - 1, F.lit(0))).alias("a"), other.alias("b"))
    s = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(_ratio(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return rows.agg(F.avg(s).alias("silhouette"))
