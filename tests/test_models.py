"""Fitted models against closed forms in numpy, and invariants of tuning and ensembles."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes as MlNaiveBayes
from pyspark.sql import functions as F

from larkspur.models import bayes, classifiers, ensemble, linear, semi, tune
from larkspur.operators import evaluate, split


def table(n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 2.0, 0.5]
    y = 3 * x[:, 0] - 1.5 * x[:, 1] + 0.3 * rng.normal(size=n) + 2
    c = (x[:, 0] + 0.5 * rng.normal(size=n) > 0.3).astype(float)
    return x, y, c


@pytest.fixture(scope="module")
def data(spark):
    x, y, c = table()
    rows = [(i, *map(float, x[i]), float(y[i]), float(c[i]), 3.0 if c[i] else 1.0) for i in range(len(y))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, d double, y double, c double, w double").cache()
    return df, x, y, c


FEATS = ["a", "b", "d"]


def descend(x, y, alpha, l1, rounds=5000):
    n, xm, ym = len(y), x.mean(0), y.mean()
    z, t, w = x - xm, y - ym, np.zeros(x.shape[1])
    for _ in range(rounds):
        for j in range(len(w)):
            rho = z[:, j] @ (t - z @ w + z[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0) / (z[:, j] @ z[:, j] / n + alpha * (1 - l1))
    return w, ym - xm @ w


@pytest.mark.parametrize("alpha,l1", [(0.2, 0.0), (0.5, 0.4), (1.0, 0.1), (0.3, 1.0)])
def test_elastic_net(data, alpha, l1):
    df, x, y, _ = data
    m = linear.fit_elastic_net(df, FEATS, "y", alpha, l1).stages[-1]
    w, b = descend(x, y, alpha, l1, 300)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-4) and abs(m.intercept - b) < 1e-3


def test_ols_and_ridge(data):
    df, x, y, _ = data
    z = np.column_stack([x, np.ones(len(y))])
    want = np.linalg.lstsq(z, y, rcond=None)[0]
    m = linear.fit_ols(df, FEATS, "y").stages[-1]
    assert np.allclose([*m.coefficients.toArray(), m.intercept], want, atol=1e-8)
    zc, yc = x - x.mean(0), y - y.mean()
    ridge = np.linalg.solve(zc.T @ zc + 50 * np.eye(3), zc.T @ yc)
    assert np.allclose(linear.fit_ridge(df, FEATS, "y", 50.0).stages[-1].coefficients.toArray(), ridge, atol=1e-4)


@pytest.mark.parametrize("C,weight", [(0.05, None), (0.01, "w")])
def test_logistic(data, C, weight):
    df, x, _, c = data
    z, w = np.column_stack([x, np.ones(len(c))]), np.where(c > 0, 3.0, 1.0) if weight else np.ones(len(c))
    beta, pen = np.zeros(4), np.diag([1.0, 1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        beta -= np.linalg.solve(C * (z * (w * p * (1 - p))[:, None]).T @ z + pen, C * z.T @ (w * (p - c)) + pen @ beta)
    m = linear.fit_logistic(df, FEATS, "c", C=C, weight=weight).stages[-1]
    assert np.allclose([*m.coefficients.toArray(), m.intercept], beta, atol=1e-4)


def test_elastic_net_path_from_sums(data):
    df, x, y, _ = data
    folds = df.withColumn("fold", (F.col("id") % 4).cast("int"))
    got = {(r["l1_ratio"], r["alpha"]): r["mse"] for r in tune.elastic_net_cv(folds, FEATS, "y", "fold", [0.2, 0.9], [0.01, 0.5]).collect()}
    fold = np.arange(len(y)) % 4
    for l1 in (0.2, 0.9):
        for a in (0.01, 0.5):
            errors = []
            for f in range(4):
                tr, te = fold != f, fold == f
                mu, sd = x[tr].mean(0), x[tr].std(0)
                w, b = descend((x[tr] - mu) / sd, y[tr], a, l1, 300)
                errors.append(((y[te] - b - (x[te] - mu) / sd @ w) ** 2).mean())
            assert abs(got[(l1, a)] - np.mean(errors)) < 1e-6


def test_auc_counts_pairs(spark):
    rng = np.random.default_rng(2)
    s, y = rng.integers(0, 30, 300), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    p, q = s[y == 1], s[y == 0]
    want = ((p[:, None] > q[None]).sum() + 0.5 * (p[:, None] == q[None]).sum()) / (len(p) * len(q))
    assert abs(evaluate.auc(df).first()[0] - want) < 1e-12
    roc = evaluate.roc_points(df).orderBy("fpr", "tpr").collect()
    area = np.trapezoid([0, *[r["tpr"] for r in roc]], [0, *[r["fpr"] for r in roc]])
    assert abs(area - want) < 1e-12


def test_rand_index_counts_pairs(spark):
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 4, 80), rng.integers(0, 3, 80)
    i, j = np.triu_indices(80, 1)
    same_a, same_b = a[i] == a[j], b[i] == b[j]
    both, total = (same_a & same_b).sum(), len(i)
    expected = same_a.sum() * same_b.sum() / total
    want = (both - expected) / ((same_a.sum() + same_b.sum()) / 2 - expected)
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a int, b int")
    assert abs(evaluate.adjusted_rand(df, "a", "b").first()[0] - want) < 1e-12


def test_multinomial_nb_matches_ml_but_for_the_prior(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, (40, 6))
    y = np.array([0] * 30 + [1] * 10)
    terms = spark.createDataFrame([(i, f"t{j}", int(x[i, j])) for i in range(40) for j in range(6) if x[i, j]], "id bigint, term string, tf bigint")
    labels = spark.createDataFrame([(i, int(y[i])) for i in range(40)], "id bigint, y int")
    m = bayes.fit_multinomial_nb(terms, labels, "id", "y", alpha=0.5)
    got = {(r["class"], r["term"]): r["log_prob"] for r in m.table.collect()}
    for c in (0, 1):
        sums = x[y == c].sum(0)
        for j in range(6):
            assert abs(got[(c, f"t{j}")] - np.log((sums[j] + 0.5) / (sums.sum() + 3.0))) < 1e-12
    assert np.allclose(m.log_priors, np.log([0.75, 0.25]))
    empty = bayes.predict_multinomial_nb(terms.where("id < 0"), labels, "id", m).select("prediction").distinct().collect()
    assert [r[0] for r in empty] == [0]


def test_categorical_nb_with_unseen_and_null(spark):
    df = spark.createDataFrame([("x", "p", 0), ("x", "q", 0), ("y", "q", 1), ("y", None, 1)], "a string, b string, y int")
    m = bayes.fit_categorical_nb(df, ["a", "b"], "y", 1.0)
    new = spark.createDataFrame([("y", "q"), ("z", "p"), (None, None)], "a string, b string")
    got = bayes.predict_categorical_nb(new, m, scores="s").collect()
    # a: 2 values, b: 2 values; class 1 holds b once
    assert np.allclose(got[0]["s"], [np.log(0.5 * (1 / 4) * (2 / 4)), np.log(0.5 * (3 / 4) * (2 / 3))])
    assert np.allclose(got[1]["s"], [np.log(0.5 * (1 / 4) * (2 / 4)), np.log(0.5 * (1 / 4) * (1 / 3))])
    assert np.allclose(got[2]["s"], np.log([0.5, 0.5])) and got[2]["prediction"] == 0


def test_cv_predict_has_each_row_once(data):
    df = split.kfold(data[0], "id", 3)
    pipe = linear.with_features(FEATS, LogisticRegression(labelCol="c"))
    got = tune.cv_predict(df, pipe, "fold", 3)
    assert got.count() == 400 == got.select("id").distinct().count()
    scores = tune.cv_scores(df, pipe, "fold", 3, "accuracy", "c").collect()
    assert len(scores) == 3 and all(0.7 < r["score"] <= 1 for r in scores)


def test_permutation_importance_ranks_the_signal_first(data):
    df = data[0]
    got = tune.permutation_importance(classifiers.fit_tree(df, FEATS, "c"), df, "id", FEATS, "accuracy", "c").collect()
    assert got[0]["feature"] == "a" and got[0]["drop"] > 0.1


def test_adaboost_improves_on_one_stump(data):
    va = linear.VectorAssembler(inputCols=FEATS, outputCol="features")
    df = va.transform(data[0]).withColumn("t", ((F.abs("a") > 0.7)).cast("double"))
    one = evaluate.accuracy(ensemble.fit_adaboost(df, DecisionTreeClassifier(maxDepth=1), "t", 1).transform(df).withColumnRenamed("t", "label")).first()[0]
    many = evaluate.accuracy(ensemble.fit_adaboost(df, DecisionTreeClassifier(maxDepth=1), "t", 8, cut_every=3).transform(df).withColumnRenamed("t", "label")).first()[0]
    assert many > one


def test_self_training_adds_only_sure_rows(data):
    va = linear.VectorAssembler(inputCols=FEATS, outputCol="features")
    df = va.transform(data[0]).select("id", "features", "c")
    known, rest = df.where("id % 5 = 0"), df.where("id % 5 <> 0").select("id", "features")
    fit = lambda d: linear.fit_logistic(d, "features", "c", C=10.0)
    model, rows = semi.self_train(fit, known, rest, "c", threshold=0.95, rounds=4)
    assert known.count() < rows.count() <= 400 and rows.select("id").distinct().count() == rows.count()
    nothing, same = semi.self_train(fit, known, rest, "c", threshold=1.01)
    assert same.count() == known.count()


def test_stack_and_committee_predict_every_row(data):
    df = split.kfold(data[0], "id", 3)
    va = linear.VectorAssembler(inputCols=FEATS, outputCol="features")
    vec = va.transform(df)
    stack = ensemble.fit_stack(vec, [LogisticRegression(labelCol="c"), DecisionTreeClassifier(labelCol="c")], "c", "fold", 3, classifiers.forest("c", trees=5))
    got = stack.transform(vec).withColumnRenamed("c", "label")
    assert got.count() == 400 and evaluate.accuracy(got).first()[0] > 0.75
    com = ensemble.fit_committee(df, "id", FEATS * 2, "c", LogisticRegression(regParam=0.01), n=3, rows=200, redraw=100, meta=classifiers.forest("c", trees=5))
    got = com.transform(df).withColumnRenamed("c", "label")
    assert got.count() == 400 and evaluate.accuracy(got).first()[0] > 0.6


def test_adaboost_takes_naive_bayes(data):
    va = linear.VectorAssembler(inputCols=["p", "q"], outputCol="features")
    df = va.transform(data[0].withColumn("p", F.abs("a")).withColumn("q", F.greatest("a", F.lit(0.0))))
    m = ensemble.fit_adaboost(df, MlNaiveBayes(), "c", 3)
    assert evaluate.accuracy(m.transform(df).withColumnRenamed("c", "label")).first()[0] > 0.7


def test_forest_sweep_scores_prefixes_of_one_forest(data):
    df = data[0]
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    got = {(r["strategy"], r["trees"]): r["error"] for r in tune.sweep_forest(train, test, FEATS, "c", [1, 2, 12], ["all", "sqrt"]).collect()}
    assert sorted(got) == [(s, n) for s in ("all", "sqrt") for n in (1, 2, 12)]
    for s in ("all", "sqrt"):
        model = classifiers.fit_forest(train, FEATS, "c", 12, 5, s)
        assert got[s, 12] == pytest.approx(1 - tune.evaluator("accuracy", "c").evaluate(model.transform(test)))
        first = model.stages[-1].trees[0].setFeaturesCol("features")
        one = first.transform(model.stages[0].transform(test)).where("prediction <> c").count()
        assert got[s, 1] == pytest.approx(one / test.count())


@pytest.mark.parametrize(
    "name, owner, fit, figure, least",
    [
        ("mdl11_forest", "classifiers", "fit_forest", "trees", 85), ("mdl12_extra_trees", "trees", "fit_extra_trees", "trees", 85),
        ("mdl13_boosted", "classifiers", "fit_boosted", "rounds", 200), ("mdl13_boosted_multiclass", "boosting", "fit_boosting", "rounds", 200),
        ("mdl14_svc", "classifiers", "fit_svc", "rounds", 100), ("mdl16_mlp", "classifiers", "fit_mlp", "rounds", 500),
        ("mdl17_adaboost_naive_bayes", "ensemble", "fit_adaboost", "rounds", 50), ("mdl17_adaboost_stumps", "ensemble", "fit_adaboost", "rounds", 50),
        ("mdl20_stack", "classifiers", "forest", "trees", 100), ("tun8_sweep_forest", "trees", "sweep_forest", "sizes", range(40, 176)), ("tun8_sweep_forest_held_out", "tune", "sweep_forest", "sizes", range(40, 176)),
    ],
)
def test_model_queries_do_the_whole_work(spark, sf, monkeypatch, name, owner, fit, figure, least):
    import inspect

    from larkspur.plans import models

    class Asked(Exception):
        pass

    sign = inspect.signature(getattr(getattr(models, owner), fit))

    def ask(*args, **kwargs):
        bound = sign.bind(*args, **kwargs)
        bound.apply_defaults()
        raise Asked(bound.arguments[figure])

    monkeypatch.setattr(getattr(models, owner), fit, ask)
    with pytest.raises(Asked) as asked:
        models_query(name)(spark, sf)
    assert asked.value.args[0] == least


def models_query(name):
    import __spark_entry__

    return __spark_entry__.queries()[name]


def test_vectors_lie_in_few_partitions(spark, sf):
    """What loops read again and again must not have a task for each of a shuffle's partitions."""
    from larkspur.plans.models import vectors
    from larkspur.session import gather

    parts = spark.conf.get("spark.sql.shuffle.partitions")
    most = 2 * spark.sparkContext.defaultParallelism
    try:
        spark.conf.set("spark.sql.shuffle.partitions", most + 40)
        e = vectors(spark, sf)
        assert e.rdd.getNumPartitions() <= most and e.select("vec_id").distinct().count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()
        e.unpersist()
        assert gather(spark.range(0, 100, 1, 90), 30 * 250_000).rdd.getNumPartitions() == max(most, 30)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
