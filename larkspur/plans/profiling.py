"""Profiling and cleaning queries."""

from pyspark.sql import functions as F

from larkspur.functions import codes
from larkspur.operators import clean, profile
from larkspur.operators.split import kfold
from larkspur.plans.registry import load, query


@query(
    "prf1_profile_shape",
    """SELECT c.n_rows, CAST(o.ordinal_position AS BIGINT) AS position, o.column_name AS "column"
       FROM (SELECT CAST(count(*) AS BIGINT) AS n_rows FROM orders) c,
            information_schema.columns o WHERE o.table_name = 'orders'""",
)
def _(spark, sf):
    return profile.profile_shape(load(spark, sf, "orders")).drop("type")


@query(
    "prf2_describe_numeric",
    """SELECT "column", CAST(count(v) AS BIGINT) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
              min(v) AS "min", max(v) AS "max", round(quantile_cont(v, 0.25), 6) AS q25,
              round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75
       FROM (SELECT 'l_quantity' AS "column", l_quantity AS v FROM lineitem
             UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
             UNION ALL SELECT 'l_discount', l_discount FROM lineitem
             UNION ALL SELECT 'l_tax', l_tax FROM lineitem) GROUP BY "column" """,
)
def _(spark, sf):
    d = profile.describe_numeric(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return d.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "prf3_null_counts",
    """WITH t AS (SELECT nullif(p_type, 'PROMO') AS p_type, nullif(p_size, 7) AS p_size, p_brand FROM part)
       SELECT * FROM (SELECT 'p_type' AS "column", CAST(count(*) FILTER (p_type IS NULL) AS BIGINT) AS n_missing FROM t
       UNION ALL SELECT 'p_size', count(*) FILTER (p_size IS NULL) FROM t
       UNION ALL SELECT 'p_brand', count(*) FILTER (p_brand IS NULL) FROM t) WHERE n_missing > 0""",
)
def _(spark, sf):
    t = load(spark, sf, "part").select(
        F.expr("nullif(p_type, 'PROMO')").alias("p_type"), F.expr("nullif(p_size, 7)").alias("p_size"), "p_brand"
    )
    return profile.null_counts(t)


@query(
    "prf4_missing_report",
    """WITH t AS (SELECT CASE WHEN p_type = 'PROMO' THEN '?' ELSE p_type END AS p_type, nullif(p_size, 7) AS p_size, p_brand FROM part),
       n AS (SELECT count(*) AS n FROM t),
       m AS (SELECT 'p_type' AS "column", count(*) FILTER (p_type IS NULL OR p_type = '?') AS k FROM t
       UNION ALL SELECT 'p_size', count(*) FILTER (p_size IS NULL) FROM t
       UNION ALL SELECT 'p_brand', count(*) FILTER (p_brand IS NULL OR p_brand = '?') FROM t)
       SELECT "column", CAST(k AS BIGINT) AS n_missing, round(100.0 * k / n, 6)::DOUBLE AS percent FROM m, n""",
)
def _(spark, sf):
    t = load(spark, sf, "part").select(
        F.when(F.col("p_type") == "PROMO", "?").otherwise(F.col("p_type")).alias("p_type"),
        F.expr("nullif(p_size, 7)").alias("p_size"),
        "p_brand",
    )
    return profile.missing_report(t).withColumn("percent", F.round("percent", 6))


@query(
    "prf5_value_counts",
    """SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, round(count(*) / (SELECT count(*) FROM orders), 9)::DOUBLE AS share
       FROM orders GROUP BY 1""",
)
def _(spark, sf):
    return profile.value_counts(load(spark, sf, "orders"), "o_orderstatus", True).withColumn("share", F.round("share", 9))


@query(
    "prf6_duplicate_count",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def _(spark, sf):
    return profile.duplicate_count(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "prf7_imbalance_ratio",
    """SELECT CAST(max(n) AS BIGINT) AS largest, CAST(min(n) AS BIGINT) AS smallest, round(max(n) / min(n), 9)::DOUBLE AS ratio
       FROM (SELECT count(*) AS n FROM events GROUP BY event_type)""",
)
def _(spark, sf):
    return profile.imbalance_ratio(load(spark, sf, "events"), "event_type").withColumn("ratio", F.round("ratio", 9))


FOLD_SQL = """f AS (SELECT *, CAST((row_number() OVER (ORDER BY ('0x' || substr(md5(o_orderkey || '|42'), 1, 8))::BIGINT, o_orderkey) - 1) % 5 AS INT) AS fold FROM orders)"""


@query(
    "prf8_distinct_per_fold",
    f"""WITH {FOLD_SQL}, k AS (SELECT unnest(range(5)) AS fold),
       l AS (SELECT fold, 'o_orderpriority' AS "column", o_orderpriority AS v FROM f
             UNION ALL SELECT fold, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM f)
       SELECT CAST(k.fold AS INT) AS fold, "column", CAST(count(DISTINCT CASE WHEN l.fold <> k.fold THEN v END) AS BIGINT) AS train_distinct,
              CAST(count(DISTINCT CASE WHEN l.fold = k.fold THEN v END) AS BIGINT) AS test_distinct
       FROM k, l GROUP BY 1, 2""",
)
def _(spark, sf):
    folds = kfold(load(spark, sf, "orders"), "o_orderkey", 5)
    return profile.distinct_per_fold(folds, ["o_orderpriority", "o_custkey"], "fold", 5)


@query(
    "prf9_histogram",
    """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
       SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19) AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n
       FROM lineitem, e GROUP BY 1""",
)
def _(spark, sf):
    return profile.histogram(load(spark, sf, "lineitem"), "l_extendedprice", 20)


@query(
    "prf10_five_number",
    """SELECT l_returnflag, min(l_extendedprice) AS "min", round(quantile_cont(l_extendedprice, 0.25), 6) AS q25,
              round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.75), 6) AS q75,
              max(l_extendedprice) AS "max" FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    f = profile.five_number(load(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return f.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})


@query(
    "prf11_columns_of_kind",
    """SELECT round(sum(c_custkey), 2)::DOUBLE AS c_custkey, round(sum(c_nationkey), 2)::DOUBLE AS c_nationkey, round(sum(c_acctbal), 2) AS c_acctbal FROM customer""",
)
def _(spark, sf):
    t = load(spark, sf, "customer")
    return t.agg(*[F.round(F.sum(c).cast("double"), 2).alias(c) for c in profile.columns_of(t, "numeric")])


@query(
    "prf12_non_numeric_rows",
    """SELECT p_partkey, code FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_type ELSE CAST(p_size AS VARCHAR) END AS code FROM part)
       WHERE TRY_CAST(code AS DOUBLE) IS NULL""",
)
def _(spark, sf):
    t = load(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise(F.col("p_size").cast("string")).alias("code")
    )
    return profile.non_numeric_rows(t, "code")


@query("prf13_sorted_distinct", "SELECT DISTINCT p_brand FROM part ORDER BY 1")
def _(spark, sf):
    return profile.sorted_distinct(load(spark, sf, "part"), "p_brand")


@query(
    "cln1_tokens_to_null",
    "SELECT p_partkey, nullif(nullif(p_type, 'PROMO'), 'SMALL') AS p_type, p_brand FROM part",
)
def _(spark, sf):
    t = load(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    return clean.tokens_to_null(t, ["PROMO", "SMALL"], ["p_type"])


@query(
    "cln2_fill_constant",
    "SELECT p_partkey, coalesce(nullif(p_type, 'PROMO'), 'Unknown') AS p_type, coalesce(nullif(p_size, 7), 0) AS p_size FROM part",
)
def _(spark, sf):
    t = load(spark, sf, "part").select(
        "p_partkey", F.expr("nullif(p_type, 'PROMO')").alias("p_type"), F.expr("nullif(p_size, 7)").alias("p_size")
    )
    return clean.fill_constant(t, {"p_type": "Unknown", "p_size": 0})


IMPUTE_SRC = "SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS price, CASE WHEN p_size % 5 <> 0 THEN p_type END AS kind FROM part"


@query(
    "cln3_impute_median_mode",
    f"""WITH t AS ({IMPUTE_SRC}), m AS (SELECT quantile_cont(price, 0.5) AS med FROM t),
       k AS (SELECT kind AS top FROM t WHERE kind IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
       SELECT p_partkey, round(coalesce(price, med), 6) AS price, coalesce(kind, top) AS kind FROM t, m, k""",
)
def _(spark, sf):
    t = _impute_src(spark, sf)
    return clean.apply_imputer(t, clean.fit_imputer(t, ["price"], ["kind"])).withColumn("price", F.round("price", 6))


@query(
    "cln3_impute_mean",
    f"""WITH t AS ({IMPUTE_SRC}), m AS (SELECT avg(price) AS m FROM t)
       SELECT p_partkey, round(coalesce(price, m), 6) AS price FROM t, m""",
)
def _(spark, sf):
    t = _impute_src(spark, sf).select("p_partkey", "price")
    return clean.apply_imputer(t, clean.fit_imputer(t, ["price"], how="mean")).withColumn("price", F.round("price", 6))


def _impute_src(spark, sf):
    return load(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("kind"),
    )


@query("cln4_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(spark, sf):
    return clean.drop_columns(
        load(spark, sf, "orders"), ["o_totalprice", "o_orderdate", "o_orderpriority", "not_there"]
    )


@query(
    "cln5_to_numeric",
    "SELECT p_partkey, TRY_CAST(CASE WHEN p_size % 3 = 0 THEN '?' ELSE CAST(p_size AS VARCHAR) END AS BIGINT) AS code FROM part",
)
def _(spark, sf):
    t = load(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") % 3 == 0, "?").otherwise(F.col("p_size").cast("string")).alias("code")
    )
    return clean.to_numeric(t, ["code"], "bigint")


@query("cln6_autocast", "SELECT p_partkey, CAST(p_size AS BIGINT) AS size, p_brand FROM part")
def _(spark, sf):
    t = load(spark, sf, "part").select("p_partkey", F.col("p_size").cast("string").alias("size"), "p_brand")
    return clean.autocast(t)


@query(
    "cln7_recode",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS o_orderstatus,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'top' WHEN '2-HIGH' THEN 'top' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    t = clean.recode(t, "o_orderstatus", {"F": 0, "O": 1})
    return clean.recode(t, "o_orderpriority", {"1-URGENT": "top", "2-HIGH": "top"}, keep=True)


@query("cln8_binarize_label", "SELECT o_orderkey, CAST(o_orderstatus IN ('F', 'P') AS INT) AS o_orderstatus FROM orders")
def _(spark, sf):
    return clean.binarize_label(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "P"])


@query(
    "cln9_exclude",
    """SELECT num, CAST(count(*) AS BIGINT) AS n FROM (SELECT nullif(l_linenumber, 7) AS num FROM lineitem)
       WHERE num IS NULL OR num NOT IN (1, 3, 4) GROUP BY 1""",
)
def _(spark, sf):
    t = load(spark, sf, "lineitem").select(F.expr("nullif(l_linenumber, 7)").alias("num"))
    return clean.exclude(t, "num", [1, 3, 4]).groupBy("num").agg(F.count("*").alias("n"))


@query(
    "cln10_first_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return clean.first_per_key(t, "o_custkey", ["o_orderkey"])


@query("cln11_count_per_key", "SELECT o_orderkey, o_custkey, CAST(count(*) OVER (PARTITION BY o_custkey) AS BIGINT) AS num_visits FROM orders")
def _(spark, sf):
    return clean.count_per_key(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "num_visits")


@query("cln12_rename", "SELECT p_partkey AS part_id, p_brand AS brand FROM part")
def _(spark, sf):
    return clean.rename(load(spark, sf, "part").select("p_partkey", "p_brand"), {"p_partkey": "part_id", "p_brand": "brand"})


@query("cln13_replace_value", "SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'SMALL' ELSE p_type END AS p_type FROM part")
def _(spark, sf):
    return clean.replace_value(load(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "PROMO", "SMALL")


@query(
    "cln14_cast_columns",
    "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(rich AS INT) AS rich FROM (SELECT *, c_acctbal > 5000 AS rich FROM customer)",
)
def _(spark, sf):
    t = load(spark, sf, "customer").select("c_custkey", "c_nationkey", (F.col("c_acctbal") > 5000).alias("rich"))
    return clean.cast_columns(t, {"c_nationkey": "string", "rich": "int"})


@query(
    "cln15_drop_blank",
    r"""SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, CASE WHEN n_chars < 200 THEN E' \n ' ELSE text END AS text FROM documents)
       WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''""",
)
def _(spark, sf):
    t = load(spark, sf, "documents").select(
        "doc_id", "n_chars", F.when(F.col("n_chars") < 200, " \n ").otherwise(F.col("text")).alias("text")
    )
    return clean.drop_blank(t, "text").select("doc_id", "n_chars")


CODE_SQL = """t AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'V' || (p_partkey % 90) WHEN p_partkey % 13 = 0 THEN 'E8' || (p_partkey % 100)
              WHEN p_partkey % 17 = 0 THEN '?' WHEN p_partkey % 5 = 0 THEN '250.' || (p_partkey % 100) ELSE CAST(p_partkey % 1000 AS VARCHAR) END AS code FROM part),
       n AS (SELECT *, CASE WHEN substr(code, 1, 1) IN ('E', 'V') THEN 7777 ELSE TRY_CAST(code AS DOUBLE) END AS num FROM t)"""


def _codes(spark, sf):
    k = F.col("p_partkey")
    code = (
        F.when(k % 11 == 0, F.concat(F.lit("V"), k % 90))
        .when(k % 13 == 0, F.concat(F.lit("E8"), k % 100))
        .when(k % 17 == 0, "?")
        .when(k % 5 == 0, F.concat(F.lit("250."), k % 100))
        .otherwise((k % 1000).cast("string"))
    )
    return load(spark, sf, "part").select("p_partkey", code.alias("code"))


@query("cln16_icd_number", f"WITH {CODE_SQL} SELECT p_partkey, code, num FROM n")
def _(spark, sf):
    return _codes(spark, sf).withColumn("num", codes.icd_number("code"))


@query(
    "cln17_icd_group",
    f"""WITH {CODE_SQL} SELECT p_partkey, CASE
         WHEN num BETWEEN 390 AND 459 OR num = 785 THEN 'circulatory' WHEN num BETWEEN 460 AND 519 OR num = 786 THEN 'respiratory'
         WHEN num BETWEEN 520 AND 579 OR num = 787 THEN 'digestive' WHEN num BETWEEN 250 AND 250.99 THEN 'diabetes'
         WHEN num BETWEEN 800 AND 999 THEN 'injury' WHEN num BETWEEN 710 AND 739 THEN 'musculoskeletal'
         WHEN num BETWEEN 580 AND 629 OR num = 788 THEN 'genitourinary'
         WHEN num BETWEEN 290 AND 319 OR num = 7777 OR num BETWEEN 280 AND 289 OR num BETWEEN 320 AND 359 OR num BETWEEN 630 AND 679
              OR num BETWEEN 360 AND 389 OR num BETWEEN 740 AND 759 THEN 'other' ELSE 'neoplasms' END AS grp FROM n""",
)
def _(spark, sf):
    return _codes(spark, sf).select("p_partkey", codes.icd_group(codes.icd_number("code")).alias("grp"))


@query(
    "cln18_icd_group7",
    f"""WITH {CODE_SQL}, r AS (SELECT p_partkey, TRY_CAST(code AS DOUBLE) AS c FROM t) SELECT p_partkey, CASE
         WHEN c BETWEEN 390 AND 459 OR c = 785 THEN 'Circulatory' WHEN c BETWEEN 460 AND 519 OR c = 786 THEN 'Respiratory'
         WHEN c BETWEEN 520 AND 579 OR c = 787 THEN 'Digestive' WHEN c BETWEEN 580 AND 629 OR c = 788 THEN 'Genitourinary'
         WHEN c >= 250 AND c < 251 THEN 'Diabetes' WHEN c BETWEEN 800 AND 999 THEN 'Injury' ELSE 'Other' END AS grp FROM r""",
)
def _(spark, sf):
    return _codes(spark, sf).select("p_partkey", codes.icd_group7("code").alias("grp"))


@query(
    "cln19_range_label",
    """SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 40 THEN '[' || (((p_size - 1) // 10) * 10 + 1) || '-' || (((p_size - 1) // 10) * 10 + 10) || ']'
         ELSE '[41-50]' END AS size_range FROM part""",
)
def _(spark, sf):
    return load(spark, sf, "part").select("p_partkey", codes.range_label("p_size", 10, 40, 50).alias("size_range"))


@query(
    "cln20_indicator",
    "SELECT p_partkey, CASE WHEN kind IS NULL OR kind = 'SMALL' THEN 0 ELSE 1 END AS tested FROM (SELECT p_partkey, nullif(p_type, 'PROMO') AS kind FROM part)",
)
def _(spark, sf):
    t = load(spark, sf, "part").select("p_partkey", F.expr("nullif(p_type, 'PROMO')").alias("kind"))
    return t.select("p_partkey", clean.indicator("kind", "SMALL").alias("tested"))


@query(
    "cln21_binarize_at",
    """SELECT o_orderkey, CAST(o_totalprice > (SELECT quantile_cont(o_totalprice, 0.5) FROM orders) AS INT) AS above_median,
              CAST(o_totalprice > 50000 AS INT) AS above_fixed FROM orders""",
)
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    t = clean.binarize_at(t, "o_totalprice", "median", "above_median")
    return clean.binarize_at(t, "o_totalprice", 50000, "above_fixed").drop("o_totalprice")


@query(
    "cln22_append",
    """SELECT kind, CAST(count(*) AS BIGINT) AS n FROM (SELECT p_type AS kind FROM part UNION ALL SELECT p_type FROM part WHERE p_size > 25) GROUP BY 1""",
)
def _(spark, sf):
    t = load(spark, sf, "part").select("p_size", F.col("p_type").alias("kind"))
    return clean.append(t, t.where("p_size > 25")).groupBy("kind").agg(F.count("*").alias("n"))


@query(
    "cln23_features_label",
    """SELECT label, round(sum(f0), 3) AS f0, round(sum(f1), 3) AS f1 FROM (SELECT CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1, p_type AS label FROM part) GROUP BY 1""",
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    v = clean.features_label(load(spark, sf, "part"), "p_type", drop=["p_partkey"])
    a = vector_to_array("features")
    return v.groupBy(F.col("p_type").alias("label")).agg(F.round(F.sum(a[0]), 3).alias("f0"), F.round(F.sum(a[1]), 3).alias("f1"))
