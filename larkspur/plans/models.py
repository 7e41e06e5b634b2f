"""Fitted-model queries. Splits are by hash and models by fixed seeds; scores are on held-out rows."""

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.sql import functions as F

from larkspur.models import boosting, classifiers, cluster, committee, density, ensemble, kernel, linear, linkage, semi, trees, tune
from larkspur.operators import evaluate, split, text
from larkspur.plans.registry import load, query
from larkspur.plans.text import labelled_tokens
from larkspur.session import gather, settle, spread

PART_FEATS = ["o_custkey", "month", "year", "urgent"]


def order_features(spark, sf):
    """Numeric features of an order and a log1p price target, with a train/test part."""
    o = load(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("double").alias("o_custkey"),
        F.month("o_orderdate").cast("double").alias("month"),
        F.year("o_orderdate").cast("double").alias("year"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"),
        F.log1p("o_totalprice").alias("y"),
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
    )
    return split.split(spread(o, "o_orderkey"), "o_orderkey", 0.8)


def line_features(spark, sf):
    return load(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("y"))


LINE_FEATS = ["l_quantity", "l_discount", "l_tax"]


def vectors(spark, sf):
    """Embeddings as ml vectors, ten classes, a binary label, parts and folds."""
    rows = load(spark, sf, "embeddings")
    e = cluster.as_vectors(rows, "embedding")
    e = e.select("vec_id", "features", F.col("label").cast("double").alias("label"), (F.col("label") < 3).cast("double").alias("low"))
    return gather(split.split(split.kfold(e, "vec_id", 3), "vec_id", 0.8), rows.count()).cache()


def _parts(df):
    return df.where("part = 'train'"), df.where("part = 'test'")


def _scores(pred, label="label"):
    """Accuracy and weighted F1 of a prediction table, from one confusion table."""
    p = pred.select(F.col(label).alias("label"), F.col("prediction").cast("double").alias("prediction"))
    a = evaluate.averaged_scores(p)
    return a.agg(
        F.max(F.when(F.col("average") == "micro", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("average") == "weighted", F.col("f1"))).alias("f1"),
    )


def _coefs(model, names, digits=4):
    last = model.stages[-1]
    rows = [(n, round(float(c), digits)) for n, c in zip([*names, "intercept"], [*last.coefficients.toArray(), last.intercept])]
    return linear.model_session().createDataFrame(rows, "feature string, coefficient double")


@query(
    "mdl1_ols_one_feature",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 9) AS r2 FROM lineitem",
)
def _(spark, sf):
    m = linear.simple_regression(line_features(spark, sf), "l_quantity", "y")
    return m.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 9).alias("r2"))


# the normal equations of three centred features, solved by determinants
OLS_SQL = """WITH m AS (SELECT covar_pop(l_quantity, l_quantity) AS a, covar_pop(l_quantity, l_discount) AS b, covar_pop(l_quantity, l_tax) AS c, covar_pop(l_discount, l_discount) AS d,
   covar_pop(l_discount, l_tax) AS e, covar_pop(l_tax, l_tax) AS f, covar_pop(l_quantity, l_extendedprice) AS p, covar_pop(l_discount, l_extendedprice) AS q, covar_pop(l_tax, l_extendedprice) AS r,
   avg(l_quantity) AS mq, avg(l_discount) AS md, avg(l_tax) AS mt, avg(l_extendedprice) AS my FROM lineitem),
   t AS (SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS det FROM m),
   w AS (SELECT *, (p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r)) / det AS w1, (a * (q * f - e * r) - p * (b * f - e * c) + c * (b * r - q * c)) / det AS w2,
   (a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - d * c)) / det AS w3 FROM t)
   SELECT 'l_quantity' AS feature, round(w1, 4) AS coefficient FROM w UNION ALL SELECT 'l_discount', round(w2, 4) FROM w UNION ALL SELECT 'l_tax', round(w3, 4) FROM w
   UNION ALL SELECT 'intercept', round(my - w1 * mq - w2 * md - w3 * mt, 4) FROM w"""


@query("mdl1_ols", OLS_SQL)
def _(spark, sf):
    return _coefs(linear.fit_ols(line_features(spark, sf), LINE_FEATS, "y"), LINE_FEATS)


def net_sql(l1: str, l2: str, digits: int) -> str:
    """SQL of the elastic net: coordinate descent on the moments of the three features, by recursion."""
    soft = lambda x: f"sign({x}) * greatest(abs({x}) - {l1}, 0)"
    moments = OLS_SQL[OLS_SQL.index("m AS"): OLS_SQL.index("t AS")].replace("FROM lineitem", ", count(*) AS rows FROM lineitem")
    return f"""WITH RECURSIVE {moments} s AS (SELECT 0 AS i, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS w3 UNION ALL
       SELECT i + 1, n1, n2, {soft('(r - c * n1 - e * n2)')} / (f + {l2}) FROM (SELECT *, {soft('(q - b * n1 - e * w3)')} / (d + {l2}) AS n2
       FROM (SELECT *, {soft('(p - b * w2 - c * w3)')} / (a + {l2}) AS n1 FROM s, m WHERE i < 100))), w AS (SELECT * FROM s, m WHERE i = 100)
       SELECT 'l_quantity' AS feature, round(w1, {digits}) AS coefficient FROM w UNION ALL SELECT 'l_discount', round(w2, {digits}) FROM w UNION ALL SELECT 'l_tax', round(w3, {digits}) FROM w
       UNION ALL SELECT 'intercept', round(my - w1 * mq - w2 * md - w3 * mt, {digits}) FROM w"""


@query("mdl2_ridge", net_sql("0", "10.0 / rows", 4))
def _(spark, sf):
    return _coefs(linear.fit_ridge(line_features(spark, sf), LINE_FEATS, "y", 10.0), LINE_FEATS)


def _net(spark, sf, alpha, l1):
    return tune.fit_elastic_net_moments(line_features(spark, sf), LINE_FEATS, "y", alpha, l1).withColumn("coefficient", F.round("coefficient", 4))


@query("mdl3_lasso", net_sql("5.0", "0", 4))
def _(spark, sf):
    return _net(spark, sf, 5.0, 1.0)


@query("mdl4_elastic_net", net_sql("0.2371 * 0.99", "0.2371 * 0.01", 4))
def _(spark, sf):
    return _net(spark, sf, 0.2371, 0.99)


@query("mdl5_logistic")
def _(spark, sf):
    train, test = _parts(split.class_weights(order_features(spark, sf), "label"))
    m = linear.fit_logistic(train, PART_FEATS, "label", C=0.1, weight="weight")
    return _scores(m.transform(test))


@query("mdl6_softmax")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    return _scores(linear.fit_softmax(train, "features", "label").transform(test))


@query("mdl10_tree")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    return _scores(classifiers.fit_tree(train, "features", "label").transform(test))


@query("mdl11_forest")
def _(spark, sf):
    train, test = _parts(split.class_weights(vectors(spark, sf), "label"))
    return _scores(classifiers.fit_forest(train, "features", "label", trees=85, weight="weight").transform(test))


@query("mdl12_extra_trees")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    return _scores(trees.fit_extra_trees(train, "vec_id", "features", "label", trees=85).transform(test))


@query("mdl13_boosted")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    return _scores(classifiers.fit_boosted(train, "features", "low", depth=3, rounds=200).transform(test), "low")


@query("mdl13_boosted_multiclass")
def _(spark, sf):
    three = vectors(spark, sf).withColumn("label", F.col("label") % 3)
    train, test = _parts(three)
    return _scores(boosting.fit_boosting(train, "features", "label", depth=2, rounds=200).transform(test))


def mail_vectors(spark, sf):
    """TF-IDF vectors of labelled documents, fitted on the train part only."""
    docs = split.split_stratified(labelled_tokens(spark, sf), "doc_id", "toxic", 0.8)
    docs = docs.withColumn("label", F.col("toxic").cast("double")).cache()
    train, test = _parts(docs)
    model = text.tfidf_vectors(train, "tokens")
    keep = ["doc_id", "label", "features"]
    return model.transform(train).select(*keep).cache(), model.transform(test).select(*keep)


@query("mdl14_svc")
def _(spark, sf):
    train, test = mail_vectors(spark, sf)
    return _scores(classifiers.fit_svc(train, "features", "label", C=1.0).transform(test))


@query("mdl14_svc_rbf")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    return _scores(kernel.fit_kernel_svc(train, "features", "low", C=1.0).transform(test), "low")


@query("mdl16_mlp")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    return _scores(classifiers.fit_mlp(train, "features", "label", [64, 100, 10], rounds=500).transform(test))


@query("mdl17_adaboost_naive_bayes")
def _(spark, sf):
    train, test = mail_vectors(spark, sf)
    return _scores(ensemble.fit_adaboost(train, NaiveBayes(smoothing=0.1), "label", rounds=50).transform(test))


@query("mdl17_adaboost_stumps")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    return _scores(ensemble.fit_adaboost(train, DecisionTreeClassifier(maxDepth=1), "low", rounds=50).transform(test), "low")


@query("mdl18_self_train")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    hidden = split.mask_labels(train, "vec_id", "label", 0.5, seed=7)
    known = hidden.where("masked is not null").select("vec_id", "features", "label")
    open_rows = hidden.where("masked is null").select("vec_id", "features")
    model, rows = semi.self_train(lambda d: linear.fit_logistic(d, "features", "label", C=10.0), known, open_rows, "label", 0.95)
    return _scores(model.transform(test)).withColumn("train_rows", rows.agg(F.count("*")).scalar())


@query("mdl19_spread_labels")
def _(spark, sf):
    e = load(spark, sf, "embeddings")
    hidden = split.mask_labels(e, "vec_id", "label", 0.3)
    found = semi.spread_labels(hidden, "vec_id", "embedding", "masked", k=7, gamma=2.0)
    return _scores(hidden.where("masked is null").select("vec_id", F.col("label").cast("double").alias("label")).join(found, "vec_id"))


@query("mdl20_stack")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    bases = [LogisticRegression(labelCol="label", regParam=0.01, maxIter=25), DecisionTreeClassifier(labelCol="label", seed=1)]
    stack = ensemble.fit_stack(train, bases, "label", "fold", 3, classifiers.forest("label", seed=7))
    return _scores(stack.transform(test))


@query("mdl21_committee")
def _(spark, sf):
    """Thirty members, C by search, class weights 0.1 and 0.9."""
    train, test = _parts(order_features(spark, sf).cache())
    fit_part, meta_part = _parts(split.split(train, "o_orderkey", 0.5, seed=11, out="part"))
    c = committee.fit_committee(fit_part, "o_orderkey", PART_FEATS, "label", meta_part)
    return _scores(c.transform(test))


@query("mdl21_committee_search")
def _(spark, sf):
    """The mean accuracy of each C over five folds."""
    train, _ = _parts(order_features(spark, sf))
    c = committee.fit_committee(train, "o_orderkey", PART_FEATS, "label", train, trees=1)
    return spark.createDataFrame([(a, round(b, 9), a == c.C) for a, b in c.scores], "c double, accuracy double, best boolean")


@query("mdl22_kmeans")
def _(spark, sf):
    e = vectors(spark, sf)
    found = cluster.fit_kmeans(e, "features", 9).transform(e)
    return evaluate.cluster_sizes(found, "cluster").select("cluster", "n")


DBSCAN_SQL = """t AS (SELECT c_custkey AS id, c_acctbal AS x FROM customer), k AS (SELECT a.id, a.x FROM t a JOIN t b ON abs(a.x - b.x) <= {0} GROUP BY 1, 2 HAVING count(*) >= {1}),
   g AS (SELECT *, CASE WHEN x - lag(x) OVER (ORDER BY x, id) <= {0} THEN 0 ELSE 1 END AS gap FROM k), c AS (SELECT *, sum(gap) OVER (ORDER BY x, id) AS comp FROM g),
   r AS (SELECT *, min(id) OVER (PARTITION BY comp) AS root FROM c),
   l AS (SELECT t.id, coalesce(any_value(me.root), min(r.root)) AS root FROM t LEFT JOIN r me ON me.id = t.id LEFT JOIN r ON abs(t.x - r.x) <= {0} GROUP BY 1),
   n AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS num FROM (SELECT DISTINCT root FROM l WHERE root IS NOT NULL)),
   f AS (SELECT id, coalesce(num, -1) AS cluster FROM l LEFT JOIN n USING (root))"""


@query("mdl23_dbscan", f"WITH {DBSCAN_SQL.format(9.5, 4)} SELECT id AS c_custkey, CAST(cluster AS BIGINT) AS cluster FROM f")
def _(spark, sf):
    return cluster.dbscan(load(spark, sf, "customer"), "c_custkey", ["c_acctbal"], 9.5, 4)


SWEEP_EPS, SWEEP_MIN = [round(1.005 + 2.1 * i, 3) for i in range(10)], [2, 3, 5, 10]


@query(
    "tun7_sweep_dbscan",
    " UNION ALL ".join(
        f"""SELECT * FROM (WITH {DBSCAN_SQL.format(eps, m)} SELECT {eps}::DOUBLE AS eps, {m} AS min_samples, CAST(count(DISTINCT cluster) FILTER (cluster >= 0) AS BIGINT) AS clusters,
            CAST(count(*) FILTER (cluster < 0) AS BIGINT) AS noise, (SELECT CAST(count(*) AS BIGINT) FROM k) AS core_rows FROM f)"""
        for eps in SWEEP_EPS
        for m in SWEEP_MIN
    ),
)
def _(spark, sf):
    return density.sweep_dbscan(load(spark, sf, "customer"), "c_custkey", ["c_acctbal"], SWEEP_EPS, SWEEP_MIN)


@query("tun7_sweep_dbscan_vectors")
def _(spark, sf):
    eps = [0.1 + 1.9 / 9 * i for i in range(10)]
    return density.sweep_dbscan(load(spark, sf, "embeddings"), "vec_id", "embedding", eps, SWEEP_MIN, label="label")


@query(
    "mdl23_dbscan_vectors",
    """WITH RECURSIVE e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
       p AS (SELECT a.id AS a, b.id AS b FROM e a, e b WHERE list_distance(a.v, b.v) <= 1.12), c AS (SELECT a AS id FROM p GROUP BY 1 HAVING count(*) >= 4),
       k AS (SELECT a, b FROM p WHERE a IN (FROM c) AND b IN (FROM c)), w AS (SELECT id AS a, id AS b FROM c UNION SELECT w.a, k.b FROM w JOIN k ON w.b = k.a),
       r AS (SELECT a AS id, min(b) AS root FROM w GROUP BY 1),
       l AS (SELECT e.id, coalesce(any_value(me.root), min(r.root)) AS root FROM e LEFT JOIN r me ON me.id = e.id LEFT JOIN p ON p.a = e.id LEFT JOIN r ON r.id = p.b GROUP BY 1),
       n AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS num FROM (SELECT DISTINCT root FROM l WHERE root IS NOT NULL))
       SELECT id AS vec_id, CAST(coalesce(num, -1) AS BIGINT) AS cluster FROM l LEFT JOIN n USING (root)""",
)
def _(spark, sf):
    return cluster.dbscan(load(spark, sf, "embeddings"), "vec_id", "embedding", 1.12, 4)


SUPPLIER_FEATS = ["s_acctbal", "region"]


def supplier_points(spark, sf):
    return load(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").cast("double").alias("s_acctbal"), (F.col("s_nationkey") * 100).cast("double").alias("region"))


# the cheapest pair of all clusters merges in each step; a step's clusters are one list
WARD_SQL = """RECURSIVE s AS (
   SELECT 0 AS i, (SELECT list({'id': s_suppkey, 'x': s_acctbal::DOUBLE, 'y': s_nationkey * 100.0::DOUBLE, 'n': 1.0::DOUBLE} ORDER BY s_suppkey) FROM supplier) AS c,
      NULL::STRUCT(cost DOUBLE, a BIGINT, b BIGINT) AS m
   UNION ALL
   SELECT i + 1, [CASE WHEN t.id = m2.a THEN {'id': t.id, 'x': (t.n * t.x + o.n * o.x) / (t.n + o.n), 'y': (t.n * t.y + o.n * o.y) / (t.n + o.n), 'n': t.n + o.n} ELSE t END for t in c if t.id <> m2.b], m2
   FROM (SELECT *, [t for t in c if t.id = m2.b][1] AS o FROM (
      SELECT i, c, list_min(flatten([[{'cost': ((q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y)) * (p.n * q.n / (p.n + q.n)), 'a': p.id, 'b': q.id} for q in c if q.id > p.id] for p in c])) AS m2 FROM s WHERE len(c) > 1))),
   merges AS (SELECT m.a AS a, m.b AS b, sqrt(2 * m.cost) AS height FROM s WHERE i > 0)"""


@query("mdl24_ward_merges", f"WITH {WARD_SQL} SELECT a, b, round(height, 6) AS height FROM merges")
def _(spark, sf):
    merges = linkage.ward_merges(supplier_points(spark, sf), "s_suppkey", SUPPLIER_FEATS)
    return merges.withColumn("height", F.round("height", 6))


@query(
    "mdl24_ward_cut",
    f"""WITH {WARD_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY height, a, b) AS r, count(*) OVER () AS n FROM merges), ks AS (SELECT unnest(range(2, 11)) AS k),
       edges AS (SELECT k, a, b FROM ranked, ks WHERE r <= n + 1 - k), roots AS (SELECT k, s_suppkey AS id, s_suppkey AS root FROM supplier, ks
       UNION SELECT roots.k, e.b, roots.root FROM roots JOIN edges e ON e.k = roots.k AND e.a = roots.id),
       low AS (SELECT k, id, min(root) AS root FROM roots GROUP BY 1, 2)
       SELECT id AS s_suppkey, k::INTEGER AS k, (dense_rank() OVER (PARTITION BY k ORDER BY root) - 1)::INTEGER AS cluster FROM low""",
)
def _(spark, sf):
    rows = supplier_points(spark, sf)
    return linkage.cut_tree(settle(linkage.ward_merges(rows, "s_suppkey", SUPPLIER_FEATS)), rows, "s_suppkey", range(2, 11))


@query("mdl24_hierarchical")
def _(spark, sf):
    """Silhouette of each k from 2 to 10 clusters, all cut from one tree."""
    e = vectors(spark, sf)
    cut = settle(linkage.cut_tree(settle(linkage.ward_merges(e, "vec_id", "features")), e, "vec_id", range(2, 11)))
    out = None
    for k in range(2, 11):
        found = e.join(cut.where(F.col("k") == k).select("vec_id", "cluster"), "vec_id")
        row = evaluate.silhouette(found, "features", "cluster").withColumn("k", F.lit(k))
        out = row if out is None else out.unionByName(row)
    return out


@query("mdl24_bisecting")
def _(spark, sf):
    e = vectors(spark, sf)
    out = None
    for k in range(2, 11):
        found = cluster.fit_hierarchical(e, "features", k).transform(e)
        row = evaluate.silhouette(found, "features", "cluster").withColumn("k", F.lit(k))
        out = row if out is None else out.unionByName(row)
    return out


@query("mdl26_rank_features")
def _(spark, sf):
    o = order_features(spark, sf)
    return linear.rank_features(classifiers.fit_forest(o, PART_FEATS, "label", trees=100), PART_FEATS, 20)


@query("mdl29_cluster_feature")
def _(spark, sf):
    e = vectors(spark, sf)
    model = cluster.fit_kmeans(e, "features", 9)
    more = cluster.add_cluster_feature(e, model, "features").select("label", "part", "features_with_cluster")
    train, test = _parts(more)
    return _scores(classifiers.fit_tree(train, "features_with_cluster", "label").transform(test))


@query("mdl30_permutation_importance")
def _(spark, sf):
    train, test = _parts(order_features(spark, sf))
    model = classifiers.fit_tree(train, PART_FEATS, "label")
    return tune.permutation_importance(model, test, "o_orderkey", PART_FEATS, "accuracy", "label")


@query("tun1_grid_search")
def _(spark, sf):
    e = vectors(spark, sf)
    lr = LogisticRegression(labelCol="label", maxIter=25)
    cv = tune.grid_search(e, lr, {lr.regParam: [0.001, 0.01, 0.1]}, "fold", 3, "accuracy", "label")
    return tune.grid_table(cv, spark)


@query("tun2_elastic_net_path")
def _(spark, sf):
    o = split.kfold(order_features(spark, sf), "o_orderkey", 5)
    return tune.elastic_net_cv(o, PART_FEATS, "y", "fold", [0.1, 0.5, 0.99], [0.0001, 0.001, 0.01, 0.1])


@query("tun3_cv_scores")
def _(spark, sf):
    e = vectors(spark, sf)
    return tune.cv_scores(e, LogisticRegression(labelCol="label", regParam=0.01, maxIter=25), "fold", 3, "accuracy", "label")


@query("tun4_cv_predict")
def _(spark, sf):
    e = vectors(spark, sf)
    return tune.cv_predict(e, DecisionTreeClassifier(labelCol="label", seed=3), "fold", 3).select("vec_id", "fold", "prediction")


@query("tun5_sweep")
def _(spark, sf):
    train, test = _parts(order_features(spark, sf))
    return tune.sweep(lambda a: linear.fit_elastic_net(train, PART_FEATS, "y", a, 0.9), test, [1e-4, 1e-2, 1.0], "neg_mae", "y", "alpha")


@query("tun6_sweep_k")
def _(spark, sf):
    return cluster.sweep_k(vectors(spark, sf), "features", list(range(2, 10)))


@query("tun8_sweep_forest")
def _(spark, sf):
    """Out-of-bag error of forests of 40 to 175 trees."""
    train, _ = _parts(vectors(spark, sf))
    return trees.sweep_forest(train, "vec_id", "features", "label", range(40, 176), ["sqrt", "log2", "all"])


@query("tun8_sweep_forest_held_out")
def _(spark, sf):
    train, test = _parts(vectors(spark, sf))
    return tune.sweep_forest(train, test, "features", "label", range(40, 176), ["sqrt", "log2", "all"])


@query("tun9_grid_table")
def _(spark, sf):
    train, _ = mail_vectors(spark, sf)
    folds = split.kfold_stratified(train, "doc_id", "label", 3).cache()
    nb = NaiveBayes(labelCol="label")
    cv = tune.grid_search(folds, nb, {nb.smoothing: [0.01, 0.1, 1.0]}, "fold", 3, "accuracy", "label")
    return tune.grid_table(cv, spark)
