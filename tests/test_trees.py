"""Hash-drawn forests against trees grown one node at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.models import trees


def plain_tree(x, y, w, t, depth, k, cuts, seed, many):
    """feature, threshold and counts of tree t by recursion over its rows."""
    size = 2 ** (depth + 1) - 1
    feature, threshold, counts = np.full(size, -1), np.zeros(size), np.zeros((size, many), np.int64)

    def grow(node, rows, level):
        counts[node] = np.bincount(y[rows], w[rows], many)
        if level == depth or (counts[node] > 0).sum() < 2:
            return
        best = None
        for f in trees.node_features(seed, t, np.array([node]), x.shape[1], k)[0]:
            lo, hi = x[rows, f].min(), x[rows, f].max()
            for u in trees.cut_places(seed, t, node, np.array([f]), cuts)[0]:
                cut = lo + u * (hi - lo)
                left = rows[x[rows, f] <= cut]
                a = np.bincount(y[left], w[left], many)
                b = counts[node] - a
                if a.sum() and b.sum():
                    gain = (a**2).sum() / a.sum() + (b**2).sum() / b.sum() - (counts[node] ** 2).sum() / counts[node].sum()
                    if gain > 1e-9 * counts[node].sum() and (best is None or round(gain, 9) > best[0]):
                        best = round(gain, 9), f, cut
        if best is None:
            return
        _, feature[node], threshold[node] = best
        down = x[rows, best[1]] <= best[2]
        grow(2 * node + 1, rows[down], level + 1)
        grow(2 * node + 2, rows[~down], level + 1)

    grow(0, np.flatnonzero(w > 0), 0)
    return feature, threshold, counts


def data(spark, n=260, width=6):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(n, width)), 1)  # few values, so many ties
    x[:, 5] = 1.0  # says nothing
    y = ((x[:, 0] > 0.2).astype(int) + (x[:, 1] + 0.3 * rng.normal(size=n) > 0)) % 3
    df = spark.createDataFrame([(i, [float(a) for a in r], float(c) * 2) for i, (r, c) in enumerate(zip(x, y))], "id long, v array<double>, y double").repartition(5)
    keys = np.array([r[0] for r in df.select("id", F.xxhash64("id").alias("h")).orderBy("id").select("h").collect()])
    return df, x, y.astype(int), keys


@pytest.mark.parametrize("cuts,bootstrap,take", [(1, False, "sqrt"), (4, True, "all")])
def test_same_trees_as_one_node_at_a_time(spark, cuts, bootstrap, take):
    df, x, y, keys = data(spark)
    depth, n = 4, 6
    model = trees.fit_trees(df, "id", "v", "y", n, depth, take, cuts, bootstrap, seed=9)
    w = trees.row_weights(keys, n, 9) if bootstrap else np.ones((len(x), n), np.int64)
    k = {"sqrt": 2, "all": 6}[take]
    for t in range(n):
        f, thr, counts = plain_tree(x, y, w[:, t], t, depth, k, cuts, 9, len(model.classes))
        assert (model.feature[t] == f).all() and (model.counts[t] == counts).all()
        assert np.allclose(model.threshold[t], thr, rtol=0, atol=1e-12)
    assert (model.feature >= 0).sum() > 3 * n
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert np.mean([got[i] == 2 * y[i] for i in range(len(x))]) > 0.6
    again = trees.fit_trees(df.repartition(2), "id", "v", "y", n, depth, take, cuts, bootstrap, seed=9)
    assert (again.feature == model.feature).all() and (again.counts == model.counts).all()  # however the rows lie


def test_weights_are_poisson():
    w = trees.row_weights(np.arange(40_000), 3, 1)
    assert abs((w == 0).mean() - np.exp(-1)) < 0.01 and abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.05


def test_out_of_bag_equals_a_recount(spark):
    df, x, y, keys = data(spark, n=180)
    model = trees.fit_trees(df, "id", "v", "y", 12, 3, "sqrt", 4, True, seed=2)
    free = trees.row_weights(keys, 12, 2) == 0
    shares = model.votes(x)
    for r in trees.out_of_bag(model, df, "id", "y", range(1, 13)).collect():
        miss = rows = 0
        for i in range(len(x)):
            own = [shares[i, t] for t in range(r["trees"]) if free[i, t]]
            if own:
                rows += 1
                miss += int(np.sum(own, axis=0).argmax()) != y[i]
        assert r["rows"] == rows and r["error"] == miss / rows
    with pytest.raises(ValueError):
        trees.out_of_bag(trees.fit_extra_trees(df, "id", "v", "y", 2, 1), df, "id", "y", [1])


def test_one_class_and_sums_in_steps(spark):
    df, *_ = data(spark, n=40)
    one = trees.fit_extra_trees(df.withColumn("y", F.lit(3.0)), "id", "v", "y", 3, 2)
    assert (one.feature == -1).all() and {r["prediction"] for r in one.transform(df).collect()} == {3.0}
    parts = spark.createDataFrame([(0, 0, i, bytearray(np.array([i, 1], np.int64).tobytes())) for i in range(30)], "tree int, node int, part int, blob binary")
    got = trees._sum_blobs(parts, 4).collect()
    assert len(got) == 1 and np.frombuffer(got[0]["blob"], np.int64).tolist() == [435, 30]


def test_sweep_scores_each_strategy(spark):
    df, *_ = data(spark, n=90)
    got = {(r["strategy"], r["trees"]): r["error"] for r in trees.sweep_forest(df, "id", "v", "y", [2, 4], ["sqrt", "all"], depth=2).collect()}
    assert set(got) == {(s, n) for s in ("sqrt", "all") for n in (2, 4)} and all(0 <= e <= 1 for e in got.values())
