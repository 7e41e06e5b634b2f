"""Naive Bayes and neighbour queries."""

from pyspark.sql import functions as F

from larkspur.models import bayes
from larkspur.models.classifiers import knn_classify
from larkspur.operators import resample, split, text
from larkspur.plans.registry import load, query
from larkspur.plans.tables import H
from larkspur.plans.text import DOCS, TERMS, labelled_tokens

CAT_SQL = """s AS (SELECT o_orderkey, o_orderstatus AS y, o_orderpriority AS a, c_mktsegment AS b FROM orders JOIN customer ON o_custkey = c_custkey),
   l AS (SELECT y, 'o_orderpriority' AS "column", a AS value FROM s UNION ALL SELECT y, 'c_mktsegment', b FROM s),
   cells AS (SELECT "column", value, y FROM (SELECT DISTINCT "column", value FROM l), (SELECT DISTINCT y FROM l)),
   n AS (SELECT "column", value, y, count(*) AS n FROM l GROUP BY ALL),
   t AS (SELECT "column", value, y AS class, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY "column", y) AS total, count(*) OVER (PARTITION BY "column", y) AS k FROM cells LEFT JOIN n USING ("column", value, y)),
   p AS (SELECT *, ln((n + 1) / (total + k)) AS lp FROM t)"""


def _categories(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return o.join(c, o.o_custkey == c.c_custkey)


CAT_COLS = ["o_orderpriority", "c_mktsegment"]


@query(
    "mdl8_categorical_nb",
    f"""WITH {CAT_SQL}, pr AS (SELECT y AS class, ln(count(*) / (SELECT count(*) FROM s)) AS prior FROM s GROUP BY 1),
       sc AS (SELECT o_orderkey, pr.class, prior + pa.lp + pb.lp AS score FROM s, pr JOIN p pa ON pa.class = pr.class AND pa."column" = 'o_orderpriority' JOIN p pb ON pb.class = pr.class AND pb."column" = 'c_mktsegment'
              WHERE pa.value = a AND pb.value = b)
       SELECT o_orderkey, arg_max(class, score) AS prediction, round(max(score), 6) AS score FROM sc GROUP BY 1""",
)
def _(spark, sf):
    t = _categories(spark, sf)
    pred = bayes.predict_categorical_nb(t, bayes.fit_categorical_nb(t, CAT_COLS, "o_orderstatus", 1.0), scores="scores")
    return pred.select("o_orderkey", "prediction", F.round(F.array_max("scores"), 6).alias("score"))


@query("mdl27_nb_table", f"""WITH {CAT_SQL} SELECT "column", value, class, CAST(n AS BIGINT) AS n, round(exp(lp), 9) AS prob FROM p""")
def _(spark, sf):
    m = bayes.fit_categorical_nb(_categories(spark, sf), CAT_COLS, "o_orderstatus", 1.0)
    return bayes.nb_table(m).select("column", "value", "class", "n", F.round("prob", 9).alias("prob"))


@query("mdl27_nb_priors", "SELECT o_orderstatus AS class, CAST(count(*) AS BIGINT) AS n, round(ln(count(*) / (SELECT count(*) FROM orders)), 9) AS log_prior FROM orders GROUP BY 1")
def _(spark, sf):
    m = bayes.fit_categorical_nb(_categories(spark, sf), CAT_COLS, "o_orderstatus", 1.0)
    return m.priors().withColumn("log_prior", F.round("log_prior", 9))


@query(
    "mdl28_discriminative",
    f"""WITH {CAT_SQL} SELECT class, "column", round(max(exp(lp)), 9) AS max_prob, round(min(exp(lp)), 9) AS min_prob FROM p GROUP BY 1, 2 HAVING max(exp(lp)) > 0.205 AND min(exp(lp)) < 0.795""",
)
def _(spark, sf):
    m = bayes.fit_categorical_nb(_categories(spark, sf), CAT_COLS, "o_orderstatus", 1.0)
    d = bayes.discriminative(bayes.nb_table(m), 0.205)
    return d.withColumns({c: F.round(c, 9) for c in ("max_prob", "min_prob")})


NB_SQL = f"""{DOCS}, {TERMS}, ws AS (SELECT term, toxic AS class, sum(tf) AS n FROM tc JOIN d USING (doc_id) GROUP BY 1, 2),
   v AS (SELECT count(DISTINCT term) AS v FROM tc), cells AS (SELECT term, class FROM (SELECT DISTINCT term FROM tc), (SELECT unnest([0, 1])::INT AS class)),
   tb AS (SELECT term, class, ln((coalesce(n, 0) + 0.1) / (sum(coalesce(n, 0)) OVER (PARTITION BY class) + 0.1 * v)) AS lp FROM cells LEFT JOIN ws USING (term, class), v)"""


def _nb(spark, sf):
    docs = labelled_tokens(spark, sf)
    terms = text.term_counts(docs, "doc_id", "tokens")
    return docs, terms, bayes.fit_multinomial_nb(terms, docs, "doc_id", "toxic", alpha=0.1)


@query(
    "mdl9_multinomial_nb",
    f"""WITH {NB_SQL}, pr AS (SELECT toxic AS class, ln(count(*) / (SELECT count(*) FROM d)) AS prior FROM d GROUP BY 1),
       sc AS (SELECT doc_id, class, any_value(prior) + sum(tf * lp) AS score FROM tc JOIN tb USING (term) JOIN pr USING (class) GROUP BY 1, 2)
       SELECT doc_id, toxic, arg_max(class, score) AS prediction, round(max(score), 4) AS score FROM sc JOIN d USING (doc_id) GROUP BY 1, 2""",
)
def _(spark, sf):
    docs, terms, model = _nb(spark, sf)
    pred = bayes.predict_multinomial_nb(terms, docs, "doc_id", model)
    return pred.select("doc_id", "toxic", "prediction", F.round(F.array_max("scores"), 4).alias("score"))


@query(
    "txt21_nb_top_terms",
    f"""WITH {NB_SQL}, r AS (SELECT class, term, exp(lp) AS prob, row_number() OVER (PARTITION BY class ORDER BY exp(lp) DESC, term) AS rank FROM tb)
       SELECT class, term, round(prob, 9) AS prob, CAST(rank AS INT) AS rank FROM r WHERE rank <= 20""",
)
def _(spark, sf):
    return bayes.nb_top_terms(_nb(spark, sf)[2], 20).withColumn("prob", F.round("prob", 9))


@query(
    "mdl7_gaussian_nb",
    """SELECT l_returnflag AS class, "column", round(avg(v), 6) AS mean, round(var_pop(v), 6) AS var FROM (SELECT l_returnflag, 'l_quantity' AS "column", l_quantity AS v FROM lineitem
       UNION ALL SELECT l_returnflag, 'l_discount', l_discount * 10 FROM lineitem) GROUP BY 1, 2""",
)
def _(spark, sf):
    t = load(spark, sf, "lineitem").select("l_returnflag", "l_quantity", (F.col("l_discount") * 10).alias("l_discount"))
    m = bayes.fit_gaussian_nb(t, ["l_quantity", "l_discount"], "l_returnflag", smoothing=0.0)
    return m.table.withColumns({c: F.round(c, 6) for c in ("mean", "var")})


@query(
    "mdl7_gaussian_nb_predict",
    """WITH t AS (SELECT o_orderkey, o_orderstatus AS y, o_totalprice / 1000 AS x, (o_custkey % 50)::DOUBLE AS z FROM orders),
       m AS (SELECT y, avg(x) AS mx, var_pop(x) AS vx, avg(z) AS mz, var_pop(z) AS vz, ln(count(*) / (SELECT count(*) FROM t)) AS pr FROM t GROUP BY 1),
       e AS (SELECT 1e-9 * greatest(var_pop(x), var_pop(z)) AS e FROM t),
       s AS (SELECT o_orderkey, m.y, pr - ln(2 * pi() * (vx + e)) / 2 - pow(x - mx, 2) / (2 * (vx + e)) - ln(2 * pi() * (vz + e)) / 2 - pow(z - mz, 2) / (2 * (vz + e)) AS sc FROM t, m, e)
       SELECT o_orderkey, arg_max(y, sc) AS prediction FROM s GROUP BY 1""",
)
def _(spark, sf):
    t = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") / 1000).alias("x"), (F.col("o_custkey") % 50).cast("double").alias("z"))
    m = bayes.fit_gaussian_nb(t, ["x", "z"], "o_orderstatus")
    return bayes.predict_gaussian_nb(t, m).select("o_orderkey", "prediction")


VEC_SPLIT = f"{H.format('vec_id', 42)} / 4294967296.0 < 0.8"


@query(
    "mdl15_knn_classify",
    f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, {VEC_SPLIT} AS train FROM embeddings),
       p AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rk FROM e a, e b WHERE NOT a.train AND b.train),
       c AS (SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, label) AS o FROM p WHERE rk <= 5 GROUP BY 1, 2)
       SELECT vec_id, label AS prediction FROM c WHERE o = 1""",
)
def _(spark, sf):
    e = split.split(load(spark, sf, "embeddings"), "vec_id", 0.8)
    return knn_classify(e.where("part = 'train'"), e.where("part = 'test'"), "vec_id", "embedding", "label", 5)


SMOTE_SQL = f"""WITH e AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
   s AS (SELECT label, count(*) AS n, max(count(*)) OVER () - count(*) AS extra FROM e GROUP BY 1),
   near AS (SELECT a.id, b.id AS neighbor, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rk FROM e a JOIN e b ON a.label = b.label AND a.id <> b.id),
   r AS (SELECT id, label, n, extra, row_number() OVER (PARTITION BY label ORDER BY {H.format('id', '42base')}, id) - 1 AS i FROM e JOIN s USING (label) WHERE extra > 0),
   c AS (SELECT id, label, n, unnest(range(1, 1 + CAST(extra // n + CASE WHEN i < extra % n THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM r),
   d AS (SELECT id, label, copy, {H.format("(id || '/' || copy)", '42pick')} % least(5, n - 1) + 1 AS rk, {H.format("(id || '/' || copy)", '42u')} / 4294967296.0 AS u FROM c),
   m AS (SELECT d.label, d.id AS base, near.neighbor, d.copy, list_sum(list_transform(list_zip(x.v, w.v), lambda p: p[1] + u * (p[2] - p[1]))) AS checksum
         FROM d JOIN near ON near.id = d.id AND near.rk = d.rk JOIN e x ON x.id = d.id JOIN e w ON w.id = near.neighbor)
   SELECT label, base, neighbor, copy, round(checksum, 6) AS checksum FROM m
   UNION ALL SELECT label, id, NULL, 0, round(list_sum(v), 6) FROM e"""


@query("spl9_smote", SMOTE_SQL)
def _(spark, sf):
    made = resample.smote(load(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    return made.select("label", "base", "neighbor", "copy", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("checksum"))
