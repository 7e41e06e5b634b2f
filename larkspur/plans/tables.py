"""Join, encoding, statistics and split queries."""

from pyspark.sql import functions as F

from larkspur.operators import clean, encode, joins, split, stats
from larkspur.plans.registry import load, query

H = "('0x' || substr(md5({0} || '|{1}'), 1, 8))::BIGINT"
H42 = H.format("o_orderkey", 42)


@query(
    "jn1_attach_lookup",
    """SELECT o_orderkey, c_mktsegment, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    customer, nation = load(spark, sf, "customer"), load(spark, sf, "nation")
    t = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    t = joins.attach_lookup(t, customer, "o_custkey", ["c_mktsegment", "c_nationkey"], "c_custkey")
    t = joins.attach_lookup(t, nation, "c_nationkey", ["n_name", "n_regionkey"], "n_nationkey")
    t = joins.attach_lookup(t, load(spark, sf, "region"), "n_regionkey", ["r_name"], "r_regionkey")
    return t.select("o_orderkey", "c_mktsegment", "n_name", "r_name")


@query(
    "jn2_join_by_position",
    """SELECT a.row_id, p_partkey, p_retailprice, c_custkey, c_acctbal
       FROM (SELECT p_partkey, p_retailprice, CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS BIGINT) AS row_id FROM part) a
       JOIN (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_custkey) - 1 AS row_id FROM customer) b USING (row_id)""",
)
def _(spark, sf):
    a = load(spark, sf, "part").select("p_partkey", "p_retailprice")
    b = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_name")
    return joins.join_by_position(a, b, "p_partkey", "c_custkey", drop=["c_name"])


@query(
    "jn3_bind_features",
    """SELECT p_partkey, p_size::DOUBLE AS f0, p_retailprice AS f1, round(q, 6)::DOUBLE AS f2 FROM part
       JOIN (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""",
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    base = load(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    sums = load(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("q"))
    v = joins.bind_features(base, [sums], "p_partkey").withColumn("a", vector_to_array("features"))
    return v.select("p_partkey", *[F.round(F.col("a")[i], 6).alias(f"f{i}") for i in range(3)])


RULE_SQL = "p AS (SELECT l_returnflag AS label, CASE WHEN l_quantity > 25 THEN 'R' WHEN l_quantity > 12 THEN 'N' ELSE 'A' END AS prediction, l_quantity, l_tax FROM lineitem)"


def rule_prediction(spark, sf):
    q = F.col("l_quantity")
    pred = F.when(q > 25, "R").when(q > 12, "N").otherwise("A")
    return load(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("label"), pred.alias("prediction"), "l_quantity", "l_tax"
    )


@query(
    "jn4_misclassified",
    f"WITH {RULE_SQL} SELECT label, prediction, l_quantity, CAST(count(*) AS BIGINT) AS n FROM p WHERE label <> prediction GROUP BY ALL",
)
def _(spark, sf):
    return joins.misclassified(rule_prediction(spark, sf)).groupBy("label", "prediction", "l_quantity").agg(F.count("*").alias("n"))


@query(
    "jn5_union_scores",
    """SELECT 'status' AS model, o_orderstatus AS part, round(avg(o_totalprice), 6) AS score FROM orders GROUP BY 2
       UNION ALL SELECT 'priority', o_orderpriority, round(avg(o_totalprice), 6) FROM orders GROUP BY 2""",
)
def _(spark, sf):
    o = load(spark, sf, "orders")

    def score(col):
        return o.groupBy(F.col(col).alias("part")).agg(F.round(F.avg("o_totalprice"), 6).alias("score"))

    return joins.union_scores({"status": score("o_orderstatus"), "priority": score("o_orderpriority")})


@query(
    "enc1_one_hot",
    """SELECT o_orderkey, CAST(s IS NOT DISTINCT FROM 'F' AS INT) AS s_F, CAST(s IS NOT DISTINCT FROM 'O' AS INT) AS s_O, CAST(s IS NULL AS INT) AS s_null
       FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s FROM orders)""",
)
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("s"))
    return encode.one_hot(t, encode.fit_categories(t, ["s"]), null_indicator=True)


@query(
    "enc1_one_hot_drop_first",
    """SELECT p_partkey, CAST(p_type = 'LARGE' AS INT) AS p_type_LARGE, CAST(p_type = 'MEDIUM' AS INT) AS p_type_MEDIUM, CAST(p_type = 'PROMO' AS INT) AS p_type_PROMO,
       CAST(p_type = 'SMALL' AS INT) AS p_type_SMALL, CAST(p_type = 'STANDARD' AS INT) AS p_type_STANDARD FROM part""",
)
def _(spark, sf):
    t = load(spark, sf, "part").select("p_partkey", "p_type")
    return encode.one_hot(t, encode.fit_categories(t, ["p_type"]), drop_first=True)


@query(
    "enc2_label_encode",
    """SELECT p_partkey, CAST(coalesce(code, -1) AS BIGINT) AS p_type_code FROM (SELECT p_partkey, nullif(p_type, 'PROMO') AS t FROM part)
       LEFT JOIN (SELECT t, dense_rank() OVER (ORDER BY t) - 1 AS code FROM (SELECT DISTINCT p_type AS t FROM part WHERE p_type <> 'PROMO')) USING (t)""",
)
def _(spark, sf):
    t = load(spark, sf, "part").select("p_partkey", F.expr("nullif(p_type, 'PROMO')").alias("p_type"))
    return encode.label_encode(t, ["p_type"]).drop("p_type")


@query(
    "enc3_standardize",
    f"""WITH t AS (SELECT o_orderkey, o_totalprice, {H42} / 4294967296.0 < 0.8 AS train FROM orders),
       s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM t WHERE train)
       SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS z FROM t, s WHERE NOT train""",
)
def _(spark, sf):
    t = split.split(load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("z")), "o_orderkey")
    test = encode.apply_scaler(t.where("part = 'test'"), encode.fit_scaler(t.where("part = 'train'"), ["z"]))
    return test.select("o_orderkey", F.round("z", 6).alias("z"))


@query(
    "enc4_log_target",
    """SELECT p_partkey, round(ln(1 + p_retailprice), 6) AS logged, round(exp(p_size / 100.0) - 1, 6)::DOUBLE AS back, round(ln(p_retailprice), 6) AS plain FROM part""",
)
def _(spark, sf):
    price = F.col("p_retailprice")
    t = load(spark, sf, "part").select("p_partkey", price.alias("logged"), (F.col("p_size") / 100.0).alias("back"), price.alias("plain"))
    t = encode.log_target(encode.log_target(encode.log_target(t, "logged"), "back", "expm1"), "plain", "log")
    return t.withColumns({c: F.round(c, 6) for c in ("logged", "back", "plain")})


@query(
    "enc5_yeo_johnson_profile",
    """WITH g AS (SELECT unnest([-0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 2.5])::DOUBLE AS lam),
       t AS (SELECT lam, c_acctbal / 1000 - 4 AS x FROM customer, g),
       y AS (SELECT lam, x, CASE WHEN x >= 0 AND lam = 0 THEN ln(x + 1) WHEN x >= 0 THEN (pow(x + 1, lam) - 1) / lam
             WHEN lam = 2 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - lam) - 1) / (2 - lam) END AS y FROM t)
       SELECT lam, round(-count(*) / 2 * ln(var_pop(y)) + (lam - 1) * sum(sign(x) * ln(1 + abs(x))), 4) AS loglik FROM y GROUP BY lam""",
)
def _(spark, sf):
    t = load(spark, sf, "customer").select((F.col("c_acctbal") / 1000 - 4).alias("x"))
    p = encode.yeo_johnson_profile(t, "x", [-0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 2.5])
    return p.withColumn("loglik", F.round("loglik", 4))


@query("enc5_yeo_johnson_fit")
def _(spark, sf):
    t = load(spark, sf, "customer").select("c_custkey", "c_acctbal")
    lam = encode.fit_yeo_johnson(t, "c_acctbal")
    y = encode.apply_yeo_johnson(t, "c_acctbal", lam, "y")
    return y.agg(F.lit(round(lam, 3)).alias("lam"), F.round(F.avg("y"), 6).alias("mean"), F.round(F.stddev_pop("y"), 6).alias("std"))


CORR_SQL = """t AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * 2 + l_tax AS mix FROM lineitem),
   c AS (SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, corr(l_quantity, l_extendedprice) AS r FROM t
   UNION ALL SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM t UNION ALL SELECT 'l_quantity', 'l_tax', corr(l_quantity, l_tax) FROM t
   UNION ALL SELECT 'l_quantity', 'mix', corr(l_quantity, mix) FROM t UNION ALL SELECT 'l_extendedprice', 'l_discount', corr(l_extendedprice, l_discount) FROM t
   UNION ALL SELECT 'l_extendedprice', 'l_tax', corr(l_extendedprice, l_tax) FROM t UNION ALL SELECT 'l_extendedprice', 'mix', corr(l_extendedprice, mix) FROM t
   UNION ALL SELECT 'l_discount', 'l_tax', corr(l_discount, l_tax) FROM t UNION ALL SELECT 'l_discount', 'mix', corr(l_discount, mix) FROM t
   UNION ALL SELECT 'l_tax', 'mix', corr(l_tax, mix) FROM t)"""
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "mix"]


def _corr_src(spark, sf):
    t = load(spark, sf, "lineitem").select(*CORR_COLS[:4])
    return t.withColumn("mix", F.col("l_quantity") * 2 + F.col("l_tax"))


@query("enc6_corr_matrix", f"WITH {CORR_SQL} SELECT a, b, round(r, 6) AS r FROM c")
def _(spark, sf):
    return encode.corr_matrix(_corr_src(spark, sf), CORR_COLS).select("a", "b", F.round("r", 6).alias("r"))


@query("enc7_prune_correlated", f"""WITH {CORR_SQL} SELECT DISTINCT b AS "column" FROM c WHERE abs(r) > 0.95""")
def _(spark, sf):
    return encode.prune_correlated(encode.corr_matrix(_corr_src(spark, sf), CORR_COLS), 0.95)


@query(
    "enc7_prune_both",
    f"""WITH {CORR_SQL} SELECT b AS "column" FROM c WHERE abs(r) > 0.95 UNION SELECT a FROM c WHERE abs(r) > 0.95""",
)
def _(spark, sf):
    return encode.prune_correlated(encode.corr_matrix(_corr_src(spark, sf), CORR_COLS), 0.95, how="both")


@query(
    "enc8_select_by_target_corr",
    f"""WITH {CORR_SQL} SELECT CASE WHEN a = 'mix' THEN b ELSE a END AS "column", round(r, 6) AS r FROM c WHERE 'mix' IN (a, b) AND abs(r) > 0.2""",
)
def _(spark, sf):
    return encode.select_by_target_corr(_corr_src(spark, sf), CORR_COLS[:4], "mix").withColumn("r", F.round("r", 6))


@query("enc9_drop_constant", "SELECT p_partkey, p_size FROM part")
def _(spark, sf):
    t = load(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_size") * 0 + 3).alias("flat"))
    return encode.drop_constant(t, ["p_size", "flat"])


@query("enc10_pca")
def _(spark, sf):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    t = load(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    model = encode.fit_pca(t, "v", k=5)
    return model.transform(t).select("vec_id", F.transform(vector_to_array("pca"), lambda x: F.round(x, 4)).alias("pca"))


@query(
    "enc11_column_transformer",
    """SELECT p_partkey, round(2 + (p_size - avg(p_size) OVER ()) / stddev_samp(p_size) OVER () + (p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER (), 4) AS checksum FROM part""",
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    t = load(spark, sf, "part").select("p_partkey", "p_type", "p_brand", "p_size", "p_retailprice")
    m = encode.column_transformer(["p_type", "p_brand"], ["p_size", "p_retailprice"]).fit(t)
    return m.transform(t).select("p_partkey", F.round(F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x), 4).alias("checksum"))


@query(
    "enc12_label_indicators",
    "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INT) AS is_F, CAST(o_orderstatus = 'O' AS INT) AS is_O, CAST(o_orderstatus = 'P' AS INT) AS is_P FROM orders",
)
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return encode.label_indicators(t, "o_orderstatus", ["F", "O", "P"]).drop("o_orderstatus")


@query(
    "enc13_mutual_info",
    """WITH t AS (SELECT 'o_orderpriority' AS "column", o_orderpriority AS v, o_orderstatus AS y FROM orders
         UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR), o_orderstatus FROM orders),
       j AS (SELECT "column", v, y, count(*)::DOUBLE AS n FROM t GROUP BY ALL),
       m AS (SELECT *, sum(n) OVER (PARTITION BY "column", v) AS nx, sum(n) OVER (PARTITION BY "column", y) AS ny, sum(n) OVER (PARTITION BY "column") AS t FROM j)
       SELECT "column", round(sum(n / t * ln(n * t / (nx * ny))), 8) AS mutual_info FROM m GROUP BY 1""",
)
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_orderpriority", F.year("o_orderdate").alias("year"), "o_orderstatus")
    return encode.mutual_info(t, ["o_orderpriority", "year"], "o_orderstatus").withColumn("mutual_info", F.round("mutual_info", 8))


@query("src8_align_columns", "SELECT c_custkey, coalesce(nullif(c_nationkey, 3), 0) AS c_nationkey, 0 AS absent FROM customer")
def _(spark, sf):
    t = load(spark, sf, "customer").select("c_custkey", F.expr("nullif(c_nationkey, 3)").alias("c_nationkey"), "c_name")
    return encode.align_columns(t, ["c_custkey", "c_nationkey", "absent"])


@query("agg1_group_size", "SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2")
def _(spark, sf):
    return stats.group_size(load(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "agg2_crosstab_margins",
    """SELECT coalesce(o_orderpriority, 'All') AS o_orderpriority, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS "F", CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS "O",
       CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS "P", CAST(count(*) AS BIGINT) AS "All" FROM orders GROUP BY ROLLUP (o_orderpriority)""",
)
def _(spark, sf):
    return stats.crosstab(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], margins=True)


@query(
    "agg3_crosstab",
    """SELECT o_orderpriority, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS "F", CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS "O",
       CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS "P" FROM orders GROUP BY 1 ORDER BY 1""",
)
def _(spark, sf):
    return stats.crosstab(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


RATE_SQL = "SELECT source, round(avg(toxic), 9) AS rate, CAST(count(*) AS BIGINT) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1"


def _labelled(spark, sf):
    return load(spark, sf, "documents").select("doc_id", "source").join(load(spark, sf, "labels"), "doc_id")


@query("agg4_rate_by_group", f"{RATE_SQL} ORDER BY avg(toxic) DESC, source LIMIT 10")
def _(spark, sf):
    return stats.rate_by_group(_labelled(spark, sf), "source", "toxic", 10).withColumn("rate", F.round("rate", 9))


@query("agg5_rate_by_group_min_count", f"{RATE_SQL} HAVING count(*) > 20 ORDER BY avg(toxic) DESC, source LIMIT 10")
def _(spark, sf):
    return stats.rate_by_group(_labelled(spark, sf), "source", "toxic", 10, min_count=20).withColumn("rate", F.round("rate", 9))


@query(
    "agg6_rate_report",
    """SELECT coalesce(CAST(quality AS VARCHAR), 'all') AS part, CAST(sum(toxic) AS BIGINT) AS hits, CAST(count(*) AS BIGINT) AS n, round(avg(toxic), 9) AS rate
       FROM labels GROUP BY ROLLUP (quality)""",
)
def _(spark, sf):
    return stats.rate_report(load(spark, sf, "labels"), "quality", "toxic").withColumn("rate", F.round("rate", 9))


CHI_SQL = """WITH j AS (SELECT {0} AS a, {1} AS b, count(*)::DOUBLE AS n FROM {2} GROUP BY ALL), r AS (SELECT a, sum(n) AS ra FROM j GROUP BY 1), c AS (SELECT b, sum(n) AS cb FROM j GROUP BY 1),
   e AS (SELECT coalesce(n, 0) AS n, ra * cb / (SELECT sum(n) FROM j) AS e FROM r CROSS JOIN c LEFT JOIN j USING (a, b))
   SELECT round(sum(pow({3}, 2) / e), 6) AS statistic, CAST(((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM c) - 1) AS BIGINT) AS dof FROM e"""


@query("agg7_chi_square", CHI_SQL.format("o_orderpriority", "o_orderstatus", "orders", "n - e"))
def _(spark, sf):
    return stats.chi_square(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus").withColumn("statistic", F.round("statistic", 6))


# with eight degrees of freedom the upper tail is exp(-x/2) times the first four terms of the series of exp(x/2)
@query(
    "agg7_chi_square_p",
    f"""WITH s AS ({CHI_SQL.format("o_orderpriority", "o_orderstatus", "orders", "n - e").replace("round(sum(pow(n - e, 2) / e), 6)", "sum(pow(n - e, 2) / e)")})
       SELECT round(statistic, 6) AS statistic, dof, round(exp(-statistic / 2) * (1 + statistic / 2 + pow(statistic / 2, 2) / 2 + pow(statistic / 2, 3) / 6), 9) AS p_value FROM s""",
)
def _(spark, sf):
    found = stats.with_p_value(stats.chi_square(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"))
    return found.withColumns({"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 9)})


@query("agg7_chi_square_yates", CHI_SQL.format("quality", "toxic", "labels", "greatest(abs(n - e) - 0.5, 0)"))
def _(spark, sf):
    return stats.chi_square(load(spark, sf, "labels"), "quality", "toxic").withColumn("statistic", F.round("statistic", 6))


@query(
    "agg8_jarque_bera",
    """WITH m AS (SELECT avg(o_totalprice) AS m, count(*) AS n FROM orders), c AS (SELECT n, avg(pow(o_totalprice - m, 2)) AS m2, avg(pow(o_totalprice - m, 3)) AS m3, avg(pow(o_totalprice - m, 4)) AS m4 FROM orders, m GROUP BY n)
       SELECT CAST(n AS BIGINT) AS n, round(m3 / pow(m2, 1.5), 5) AS skew, round(m4 / m2 / m2 - 3, 5) AS kurt,
       round(n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / m2 / m2 - 3, 2) / 4), 3) AS statistic FROM c""",
)
def _(spark, sf):
    j = stats.jarque_bera(load(spark, sf, "orders"), "o_totalprice")
    return j.select("n", F.round("skew", 5).alias("skew"), F.round("kurt", 5).alias("kurt"), F.round("statistic", 3).alias("statistic"))


def _horner(c, x):
    out = str(c[0])
    for a in c[1:]:
        out = f"({out} * {x} + {a})"
    return out


_SCORE = f"""CASE WHEN low < {stats.TAIL} THEN {_horner(stats.QUANTILE_TAIL[0], 't')} / {_horner(stats.QUANTILE_TAIL[1], 't')}
    ELSE {_horner(stats.QUANTILE_MIDDLE[0], 'q * q')} * q / {_horner(stats.QUANTILE_MIDDLE[1], 'q * q')} END"""


@query(
    "agg8_shapiro_francia",
    f"""WITH r AS (SELECT c_acctbal::DOUBLE AS x, (row_number() OVER (ORDER BY c_acctbal) - 0.375::DOUBLE) / (count(*) OVER () + 0.25::DOUBLE) AS p FROM customer),
       s AS (SELECT x, p, least(p, 1 - p) AS low, least(p, 1 - p) - 0.5 AS q, sqrt(-2 * ln(least(p, 1 - p))) AS t FROM r),
       m AS (SELECT x, CASE WHEN p > 0.5 THEN -1 ELSE 1 END * ({_SCORE}) AS m FROM s),
       w AS (SELECT count(*) AS n, pow(corr(x, m), 2) * (var_pop(m) / avg(m * m)) AS w FROM m)
       SELECT n, round(w, 8) AS statistic, round((ln(1 - w) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))), 5) AS z FROM w""",
)
def _(spark, sf):
    found = stats.shapiro_francia(load(spark, sf, "customer"), "c_custkey", "c_acctbal")
    return found.select("n", F.round("statistic", 8).alias("statistic"), F.round("z", 5).alias("z"))


@query(
    "agg9_score_table",
    """SELECT event_type, CAST(count(value) AS BIGINT) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS "min", max(value) AS "max",
       round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75 FROM events GROUP BY 1""",
)
def _(spark, sf):
    t = stats.score_table(load(spark, sf, "events"), "event_type", "value")
    return t.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "agg10_mean_ci",
    """SELECT round(m, 6) AS mean, round(s, 6) AS std, round(m - 1.96 * s / sqrt(n), 6) AS low, round(m + 1.96 * s / sqrt(n), 6) AS high
       FROM (SELECT avg(value) AS m, stddev_pop(value) AS s, count(*) AS n FROM events)""",
)
def _(spark, sf):
    c = stats.mean_ci(load(spark, sf, "events"), "value")
    return c.select(*[F.round(x, 6).alias(x) for x in c.columns])


@query(
    "agg11_melt",
    "SELECT p_partkey, 'size' AS variable, p_size::DOUBLE AS value FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part",
)
def _(spark, sf):
    t = load(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return stats.melt(t, ["p_partkey"], ["size", "price"])


@query("agg12_top_k", "SELECT c_custkey, gap FROM (SELECT c_custkey, round(c_acctbal - 4500, 2) AS gap FROM customer) ORDER BY abs(gap) DESC, c_custkey LIMIT 20")
def _(spark, sf):
    t = load(spark, sf, "customer").select("c_custkey", F.round(F.col("c_acctbal") - 4500, 2).alias("gap"))
    return stats.top_k(t, "gap", 20, "c_custkey")


def _orders(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")


RANK_SQL = f"row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H42}, o_orderkey) - 1"
SIZE_SQL = "count(*) OVER (PARTITION BY o_orderstatus)"


@query("spl1_split", f"SELECT o_orderkey, CASE WHEN {H42} / 4294967296.0 < 0.8 THEN 'train' ELSE 'test' END AS part FROM orders")
def _(spark, sf):
    return split.split(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.8)


@query("spl2_split_stratified", f"SELECT o_orderkey, CASE WHEN {RANK_SQL} < round({SIZE_SQL} * 0.8) THEN 'train' ELSE 'test' END AS part FROM orders")
def _(spark, sf):
    return split.split_stratified(_orders(spark, sf), "o_orderkey", "o_orderstatus", 0.8).drop("o_orderstatus")


@query("spl3_kfold", f"SELECT o_orderkey, CAST((row_number() OVER (ORDER BY {H42}, o_orderkey) - 1) % 5 AS INT) AS fold FROM orders")
def _(spark, sf):
    return split.kfold(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5)


@query("spl4_kfold_stratified", f"SELECT o_orderkey, CAST(({RANK_SQL}) % 10 AS INT) AS fold FROM orders")
def _(spark, sf):
    return split.kfold_stratified(_orders(spark, sf), "o_orderkey", "o_orderstatus", 10).drop("o_orderstatus")


@query("spl5_safe_folds", "SELECT CAST(least(10, min(n)) AS INT) AS folds FROM (SELECT count(*) AS n FROM labels GROUP BY quality, toxic)")
def _(spark, sf):
    t = load(spark, sf, "labels").withColumn("cls", F.concat("quality", "toxic"))
    return split.safe_folds(t, "cls", 10)


@query("spl6_sample", f"SELECT o_orderkey FROM orders WHERE {H42} / 4294967296.0 < 0.5")
def _(spark, sf):
    return split.sample(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.5)


@query(
    "spl7_oversample",
    f"""WITH r AS (SELECT o_orderkey, o_orderstatus, {RANK_SQL} AS rk, {SIZE_SQL} AS n FROM orders), m AS (SELECT max(n) AS most FROM r)
       SELECT o_orderkey, o_orderstatus, CAST(unnest(range(1, 1 + CAST(most // n + CASE WHEN rk < most % n THEN 1 ELSE 0 END AS BIGINT))) AS BIGINT) AS copy FROM r, m""",
)
def _(spark, sf):
    return split.oversample(_orders(spark, sf), "o_orderkey", "o_orderstatus")


@query(
    "spl8_undersample",
    f"""WITH r AS (SELECT o_orderkey, o_orderstatus, {RANK_SQL} AS rk, {SIZE_SQL} AS n FROM orders)
       SELECT o_orderkey, o_orderstatus FROM r WHERE rk < (SELECT min(n) FROM r)""",
)
def _(spark, sf):
    return split.undersample(_orders(spark, sf), "o_orderkey", "o_orderstatus")


@query(
    "spl10_bootstrap",
    f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {H42}, o_orderkey) - 1 AS i FROM orders), t AS (SELECT count(*) AS n FROM orders),
       d AS (SELECT id AS draw, {H.format('id', '42a')} % n AS i FROM range(8166) x(id), t
             UNION ALL SELECT draw, {H.format('pick', '42a')} % n FROM (SELECT id + 8166 AS draw, {H.format('id', '42b')} % 8166 AS pick FROM range(5444) x(id)), t)
       SELECT draw, o_orderkey FROM d JOIN r USING (i)""",
)
def _(spark, sf):
    return split.bootstrap(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 8166, redraw=5444)


@query(
    "spl11_class_weights",
    f"SELECT o_orderkey, round((SELECT count(*) FROM orders) / (3.0 * {SIZE_SQL}), 9)::DOUBLE AS weight FROM orders",
)
def _(spark, sf):
    w = split.class_weights(_orders(spark, sf), "o_orderstatus")
    return w.select("o_orderkey", F.round("weight", 9).alias("weight"))


@query("spl12_mask_labels", f"SELECT o_orderkey, CASE WHEN {H42} / 4294967296.0 >= 0.2 THEN o_orderstatus END AS masked FROM orders")
def _(spark, sf):
    return split.mask_labels(_orders(spark, sf), "o_orderkey", "o_orderstatus", 0.2).drop("o_orderstatus")


@query(
    "spl13_repeat",
    " UNION ALL ".join(
        f"SELECT {s} AS seed, CAST(count(*) AS BIGINT) AS n, round(avg(o_totalprice), 6) AS mean FROM orders WHERE {H.format('o_orderkey', s)} / 4294967296.0 >= 0.8"
        for s in (1, 2, 3)
    ),
)
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")

    def score(seed):
        test = split.split(t, "o_orderkey", 0.8, seed).where("part = 'test'")
        return test.agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 6).alias("mean"))

    return split.repeat(score, [1, 2, 3])
