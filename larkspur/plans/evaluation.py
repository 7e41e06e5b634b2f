"""Evaluation queries on rule-based predictions, so that every figure has an exact answer."""

from pyspark.sql import functions as F

from larkspur.operators import evaluate as ev
from larkspur.plans.registry import load, query
from larkspur.plans.tables import RULE_SQL, rule_prediction

CLASSES = ["A", "N", "R"]
REPORT_SQL = f"""{RULE_SQL}, c AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY ALL),
   k AS (SELECT x.class, coalesce(sum(n) FILTER (label = x.class), 0) AS support, coalesce(sum(n) FILTER (prediction = x.class), 0) AS claimed,
         coalesce(sum(n) FILTER (label = x.class AND prediction = x.class), 0) AS tp FROM c, (SELECT unnest(['A', 'N', 'R']) AS class) x GROUP BY 1),
   q AS (SELECT *, coalesce(tp / nullif(claimed, 0), 0) AS pr, coalesce(tp / nullif(support, 0), 0) AS rc FROM k),
   r AS (SELECT *, coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) AS f FROM q)"""
BINARY_SQL = "b AS (SELECT CAST(l_returnflag = 'R' AS INT) AS label, CAST(l_quantity > 25 AS INT) AS prediction, l_quantity / 50 AS score, l_tax FROM lineitem)"


def binary(spark, sf):
    return load(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
        (F.col("l_quantity") / 50).alias("score"),
        "l_tax",
    )


def _round(df, *cols, n=9):
    return df.withColumns({c: F.round(c, n) for c in cols})


@query("met1_accuracy", f"WITH {RULE_SQL} SELECT round(avg(CAST(label = prediction AS INT)), 9) AS accuracy FROM p")
def _(spark, sf):
    return _round(ev.accuracy(rule_prediction(spark, sf)), "accuracy")


@query(
    "met2_confusion",
    f"""WITH {RULE_SQL}, k AS (SELECT unnest(['A', 'N', 'R', 'X']) AS label), j AS (SELECT label AS prediction FROM k)
       SELECT k.label, j.prediction, CAST((SELECT count(*) FROM p WHERE p.label = k.label AND p.prediction = j.prediction) AS BIGINT) AS n FROM k, j""",
)
def _(spark, sf):
    return ev.confusion(rule_prediction(spark, sf), [*CLASSES, "X"])


@query(
    "met3_class_report",
    f"""WITH {REPORT_SQL} SELECT class, round(pr, 9)::DOUBLE AS "precision", round(rc, 9)::DOUBLE AS recall, round(f, 9)::DOUBLE AS f1, CAST(support AS BIGINT) AS support FROM r
       UNION ALL SELECT 'macro avg', round(avg(pr), 9), round(avg(rc), 9), round(avg(f), 9), CAST(sum(support) AS BIGINT) FROM r
       UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 9), round(sum(rc * support) / sum(support), 9), round(sum(f * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM r""",
)
def _(spark, sf):
    return _round(ev.class_report(rule_prediction(spark, sf)), "precision", "recall", "f1")


@query(
    "met4_averaged_scores",
    f"""WITH {REPORT_SQL} SELECT 'macro' AS average, round(avg(pr), 9)::DOUBLE AS "precision", round(avg(rc), 9)::DOUBLE AS recall, round(avg(f), 9)::DOUBLE AS f1 FROM r
       UNION ALL SELECT 'micro', round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9) FROM r
       UNION ALL SELECT 'weighted', round(sum(pr * support) / sum(support), 9), round(sum(rc * support) / sum(support), 9), round(sum(f * support) / sum(support), 9) FROM r""",
)
def _(spark, sf):
    return _round(ev.averaged_scores(rule_prediction(spark, sf)), "precision", "recall", "f1")


ROC_SQL = """SELECT {3} score, round(sum(pos) OVER w / sum(pos) OVER (), 9)::DOUBLE AS tpr, round(sum(neg) OVER w / sum(neg) OVER (), 9)::DOUBLE AS fpr
   FROM (SELECT {0} AS score, count(*) FILTER ({1}) AS pos, count(*) FILTER (NOT ({1})) AS neg FROM {2} GROUP BY 1) WINDOW w AS (ORDER BY score DESC)"""


@query("met5_roc_points", f"WITH {BINARY_SQL} " + ROC_SQL.format("score", "label = 1", "b", ""))
def _(spark, sf):
    return _round(ev.roc_points(binary(spark, sf)), "tpr", "fpr")


@query(
    "met5_roc_by_class",
    " UNION ALL ".join("(" + ROC_SQL.format(f"round({expr}, 4)", f"o_orderstatus = '{k}'", "orders", f"'{k}' AS class,") + ")" for k, expr in {"F": "o_totalprice / 100", "O": "(o_custkey % 97)::DOUBLE", "P": "(o_orderkey % 13)::DOUBLE"}.items()),
)
def _(spark, sf):
    return _round(ev.roc_by_class(_three(spark, sf), {"F": "sf", "O": "so", "P": "sp"}), "tpr", "fpr")


def _three(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("label"),
        F.round(F.col("o_totalprice") / 100, 4).alias("sf"),
        (F.col("o_custkey") % 97).cast("double").alias("so"),
        (F.col("o_orderkey") % 13).cast("double").alias("sp"),
    )


AUC_SQL = """(SELECT sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
   FROM (SELECT {0} AS score, count(*) FILTER ({1}) AS pos, count(*) FILTER (NOT ({1})) AS neg FROM {2} GROUP BY 1)))"""


@query("met6_auc", f"WITH {BINARY_SQL} SELECT round(auc, 9) AS auc FROM " + AUC_SQL.format("score", "label = 1", "b"))
def _(spark, sf):
    return _round(ev.auc(binary(spark, sf)), "auc")


@query(
    "met6_auc_ovr",
    "SELECT round(avg(auc), 9) AS auc FROM ("
    + " UNION ALL ".join("SELECT auc FROM " + AUC_SQL.format(f"round({expr}, 4)", f"o_orderstatus = '{k}'", "orders") for k, expr in {"F": "o_totalprice / 100", "O": "(o_custkey % 97)::DOUBLE", "P": "(o_orderkey % 13)::DOUBLE"}.items())
    + ")",
)
def _(spark, sf):
    return _round(ev.auc_ovr(_three(spark, sf), {"F": "sf", "O": "so", "P": "sp"}), "auc")


@query(
    "met7_sensitivity_specificity",
    f"""WITH {BINARY_SQL} SELECT round(avg(prediction) FILTER (label = 1), 9) AS sensitivity, round(1 - avg(prediction) FILTER (label = 0), 9) AS specificity FROM b""",
)
def _(spark, sf):
    return _round(ev.sensitivity_specificity(binary(spark, sf), 1), "sensitivity", "specificity")


@query("met8_detection_rates", f'WITH {REPORT_SQL} SELECT class, round(rc, 9)::DOUBLE AS detected, round(pr, 9)::DOUBLE AS "right" FROM r')
def _(spark, sf):
    return _round(ev.detection_rates(rule_prediction(spark, sf)), "detected", "right")


REG_SQL = "g AS (SELECT o_orderkey, {0} AS label, {1} AS prediction FROM orders JOIN (SELECT o_custkey AS k, avg(o_totalprice) / 1.07 AS m FROM orders GROUP BY 1) ON o_custkey = k)"


def _regression(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    means = o.groupBy("o_custkey").agg((F.avg("o_totalprice") / 1.07).alias("prediction"))
    return o.join(means, "o_custkey").select("o_orderkey", F.col("o_totalprice").alias("label"), "prediction")


METRICS_SQL = """SELECT round(avg(abs(label - prediction)), 4) AS mae, round(avg(pow(label - prediction, 2)), 2) AS mse,
   round(1 - sum(pow(label - prediction, 2)) / (var_pop(label) * count(*)), 8) AS r2 FROM g"""


@query("met9_regression_metrics", f"WITH {REG_SQL.format('o_totalprice', 'm')} {METRICS_SQL}")
def _(spark, sf):
    m = ev.regression_metrics(_regression(spark, sf))
    return m.select(F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"), F.round("r2", 8).alias("r2"))


@query("met9_regression_metrics_expm1", f"WITH {REG_SQL.format('exp(o_totalprice / 100000) - 1', 'exp(m / 100000) - 1')} {METRICS_SQL.replace(', 4)', ', 6)').replace(', 2)) ', ', 2)) ')}")
def _(spark, sf):
    p = _regression(spark, sf).select((F.col("label") / 100000).alias("label"), (F.col("prediction") / 100000).alias("prediction"))
    m = ev.regression_metrics(p, inverse=F.expm1)
    return m.select(F.round("mae", 6).alias("mae"), F.round("mse", 2).alias("mse"), F.round("r2", 8).alias("r2"))


@query("met10_residuals", f"WITH {REG_SQL.format('o_totalprice', 'm')} SELECT o_orderkey, label, round(prediction, 5) AS prediction, round(label - prediction, 5) AS residual FROM g")
def _(spark, sf):
    return _round(ev.residuals(_regression(spark, sf)), "prediction", "residual", n=5)


SIL_SQL = """WITH t AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
   p AS (SELECT a.vec_id, a.label AS own, b.label AS c, sum(pow(list_distance(a.v, b.v), 2)) AS d, count(*) AS n FROM t a, t b GROUP BY 1, 2, 3),
   s AS (SELECT vec_id, max(CASE WHEN c = own THEN n END) AS n, max(CASE WHEN c = own THEN d / nullif(n - 1, 0) END) AS a, min(CASE WHEN c <> own THEN d / n END) AS b FROM p GROUP BY 1)
   SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 8) AS silhouette FROM s"""


@query("met11_silhouette", SIL_SQL)
def _(spark, sf):
    return _round(ev.silhouette(load(spark, sf, "embeddings"), "embedding", "label"), "silhouette", n=8)


ARI_SRC = "(SELECT label AS a, vec_id % 7 + CASE WHEN label < 4 THEN 100 ELSE 0 END AS b FROM embeddings)"


def _clusters(spark, sf):
    return load(spark, sf, "embeddings").select("label", (F.col("vec_id") % 7 + F.when(F.col("label") < 4, 100).otherwise(0)).alias("cluster"))


@query(
    "met12_adjusted_rand",
    f"""WITH c AS (SELECT a, b, count(*)::DOUBLE AS n FROM {ARI_SRC} GROUP BY 1, 2), x AS (SELECT sum(n * (n - 1) / 2) AS s FROM c),
       y AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT sum(n) AS n FROM c GROUP BY a)), z AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT sum(n) AS n FROM c GROUP BY b)),
       t AS (SELECT sum(n) * (sum(n) - 1) / 2 AS s FROM c) SELECT round((x.s - y.s * z.s / t.s) / ((y.s + z.s) / 2 - y.s * z.s / t.s), 9) AS ari FROM x, y, z, t""",
)
def _(spark, sf):
    return _round(ev.adjusted_rand(_clusters(spark, sf), "label", "cluster"), "ari")


@query(
    "met13_cluster_purity",
    f"""WITH c AS (SELECT a, b, count(*) AS n FROM {ARI_SRC} GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY b) AS size, row_number() OVER (PARTITION BY b ORDER BY n DESC, a) AS rn FROM c)
       SELECT b AS cluster, CAST(size AS BIGINT) AS size, a AS top_label, round(n / size, 9)::DOUBLE AS purity FROM r WHERE rn = 1""",
)
def _(spark, sf):
    return _round(ev.cluster_purity(_clusters(spark, sf), "label", "cluster"), "purity")


@query("met14_cluster_sizes", "SELECT vec_id % 5 - 1 AS cluster, CAST(count(*) AS BIGINT) AS n, CAST(vec_id % 5 = 0 AS INT) AS is_noise FROM embeddings GROUP BY 1, 3")
def _(spark, sf):
    return ev.cluster_sizes(load(spark, sf, "embeddings").select((F.col("vec_id") % 5 - 1).alias("cluster")), "cluster")


@query(
    "met14_noise_free_silhouette",
    SIL_SQL.replace("FROM embeddings", "FROM embeddings WHERE label <> 9"),
)
def _(spark, sf):
    return _round(ev.silhouette(load(spark, sf, "embeddings"), "embedding", "label", noise=9), "silhouette", n=8)


@query(
    "met15_inertia",
    """WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, i, avg(x) AS m FROM x GROUP BY 1, 2)
       SELECT round(sum(pow(x - m, 2)), 6) AS inertia FROM x JOIN m USING (label, i)""",
)
def _(spark, sf):
    return _round(ev.inertia(load(spark, sf, "embeddings"), "embedding", "label"), "inertia", n=6)


@query(
    "met16_compare_models",
    f"""WITH {BINARY_SQL}, m AS (SELECT 'quantity' AS model, label, prediction AS p FROM b UNION ALL SELECT 'tax', label, CAST(l_tax > 0.04 AS INT) FROM b),
       e AS (SELECT model, count(*) FILTER (label = 1 AND p = 1) AS tp, count(*) FILTER (label = 0 AND p = 1) AS fp, count(*) FILTER (label = 0 AND p = 0) AS tn, count(*) FILTER (label = 1 AND p = 0) AS fn FROM m GROUP BY 1)
       SELECT model, round((tp + tn) / (tp + tn + fp + fn), 9)::DOUBLE AS accuracy, round(tp / (tp + fp), 9)::DOUBLE AS "precision", round(tp / (tp + fn), 9)::DOUBLE AS recall, round(2 * tp / (2 * tp + fp + fn), 9)::DOUBLE AS f1 FROM e""",
)
def _(spark, sf):
    b = binary(spark, sf)
    tax = b.withColumn("prediction", (F.col("l_tax") > 0.04).cast("int"))
    return _round(ev.compare_models({"quantity": b, "tax": tax}, 1), "accuracy", "precision", "recall", "f1")


@query(
    "met17_route_by_score",
    """SELECT CASE WHEN s >= 0.95 THEN 'spam' WHEN s >= 0.8 THEN 'review' ELSE 'inbox' END AS route, CAST(count(*) AS BIGINT) AS n FROM (SELECT l_quantity / 50 AS s FROM lineitem) GROUP BY 1""",
)
def _(spark, sf):
    return ev.route_by_score(binary(spark, sf), "score").groupBy("route").agg(F.count("*").alias("n"))


@query(
    "met18_error_counts",
    f"""WITH {BINARY_SQL} SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS BIGINT) AS tp, CAST(count(*) FILTER (label = 0 AND prediction = 1) AS BIGINT) AS fp,
       CAST(count(*) FILTER (label = 0 AND prediction = 0) AS BIGINT) AS tn, CAST(count(*) FILTER (label = 1 AND prediction = 0) AS BIGINT) AS fn FROM b""",
)
def _(spark, sf):
    return ev.error_counts(binary(spark, sf), 1)


@query(
    "met19_score_distribution",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi, avg(value) AS m, stddev_pop(value) AS s FROM events)
       SELECT CAST(least(floor((value - lo) / ((hi - lo) / 10)), 9) AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n, round(any_value(m), 6) AS mean, round(any_value(s), 6) AS std, any_value(lo) AS "min", any_value(hi) AS "max" FROM events, e GROUP BY 1""",
)
def _(spark, sf):
    return _round(ev.score_distribution(load(spark, sf, "events"), 10, "value"), "mean", "std", n=6)


@query("mdl25_score_as_class", "SELECT o_orderkey, CAST(o_totalprice / 100000 > 0.5 AS INT) AS prediction FROM orders")
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 100000).alias("prediction"))
    return ev.score_as_class(t, 0.5)
