"""Neighbour search, density clusters, synthetic rows and label spreading against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.models import classifiers, cluster, semi
from larkspur.operators import evaluate, neighbors, resample


def cloud(n=600, d=3, seed=0):
    """Three uneven blobs, a third of the rows equal."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(0, 0.3, (n // 3, d)), rng.normal(3, 1.0, (n // 3, d)), np.tile(rng.normal(-2, 1, (1, d)), (n - 2 * (n // 3), 1))])
    return x


def frame(spark, x, y=None):
    rows = [(i, [float(v) for v in r], int(0 if y is None else y[i])) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, v array<double>, y int")


@pytest.mark.parametrize("block", [64, 2048])
def test_nearest_is_exact(spark, block):
    x = cloud()
    got = neighbors.nearest(frame(spark, x), frame(spark, x), "id", "v", 4, exclude_self=True, block=block).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, :4]
    have = np.full_like(want, np.nan)
    for r in got:
        have[r["id"], r["rank"] - 1] = r["distance"]
        assert r["neighbor"] != r["id"]
    assert np.allclose(have, want, atol=1e-9)


def brute_dbscan(x, eps, m):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= eps
    core = d.sum(1) >= m
    label = np.full(len(x), -1)
    k = 0
    for i in range(len(x)):
        if core[i] and label[i] == -1:
            stack = [i]
            label[i] = k
            while stack:
                j = stack.pop()
                for t in np.nonzero(d[j])[0]:
                    if label[t] == -1:
                        label[t] = k
                        if core[t]:
                            stack.append(t)
            k += 1
    return label


@pytest.mark.parametrize("eps,m", [(0.25, 4), (0.9, 5)])
def test_dbscan_is_exact(spark, eps, m, monkeypatch):
    monkeypatch.setattr(cluster, "BLOCK", 64)
    x = cloud()
    got = {r["id"]: r["cluster"] for r in cluster.dbscan(frame(spark, x), "id", "v", eps, m).collect()}
    assert [got[i] for i in range(len(x))] == list(brute_dbscan(x, eps, m))


def test_dbscan_all_noise(spark):
    got = cluster.dbscan(frame(spark, np.arange(20.0)[:, None] * 10), "id", "v", 1.0, 2)
    assert {r["cluster"] for r in got.collect()} == {-1}


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    other = spark.range(1000, 1010).select(F.lit(1000).cast("bigint").alias("a"), F.col("id").alias("b"))
    roots = {r["node"]: r["root"] for r in cluster.components(chain.union(other)).collect()}
    assert all(roots[i] == 0 for i in range(1, 301)) and all(roots[i] == 1000 for i in range(1001, 1010))


def test_smote_points_lie_on_segments(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(130, 2))
    y = np.array([0] * 100 + [1] * 27 + [2] * 3)
    made = resample.smote(frame(spark, x, y), "id", "v", "y", k=5).collect()
    assert {c: sum(r["y"] == c for r in made) for c in (0, 1, 2)} == {0: 100, 1: 100, 2: 100}
    for r in made:
        if r["neighbor"] is None:
            assert np.allclose(r["v"], x[r["base"]])
            continue
        a, b, p = x[r["base"]], x[r["neighbor"]], np.array(r["v"])
        assert y[r["base"]] == y[r["neighbor"]] == r["y"]
        u = (p - a) @ (b - a) / ((b - a) @ (b - a))
        assert -1e-9 <= u < 1 and np.allclose(a + u * (b - a), p, atol=1e-9)
        mates = [j for j in np.nonzero(y == r["y"])[0] if j != r["base"]]
        near = sorted(mates, key=lambda j: np.linalg.norm(x[j] - a))[:5]
        assert r["neighbor"] in near


def test_smote_targets(spark):
    x, y = np.random.default_rng(4).normal(size=(60, 2)), np.array([0] * 40 + [1] * 20)
    made = resample.smote(frame(spark, x, y), "id", "v", "y", targets={1: 33}).groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in made} == {0: 40, 1: 33}


def test_spread_labels_equals_dense_iteration(spark):
    x = cloud(90, 2, 5)[:60]
    y = (x[:, 0] > 1.5).astype(int)
    known = np.arange(60) % 6 == 0
    rows = [(i, [float(v) for v in x[i]], int(y[i]) if known[i] else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    got = {r["id"]: r for r in semi.spread_labels(df, "id", "v", "y", k=4, gamma=1.0, rounds=4, tol=0).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    w = np.zeros_like(d)
    for i in range(60):
        for j in np.argsort(d[i], kind="stable")[:4]:
            w[i, j] = w[j, i] = np.exp(-d[i, j] ** 2)
    deg = w.sum(1)
    s = w / np.sqrt(np.outer(deg, deg))
    start = np.stack([(y == c) & known for c in (0, 1)], 1).astype(float)
    f = start.copy()
    for _ in range(4):
        f = 0.2 * s @ f + 0.8 * start
    for i in range(60):
        if f[i].sum() > 0:
            assert abs(got[i]["score"] - f[i].max() / f[i].sum()) < 1e-9
        else:
            assert got[i]["prediction"] is None


def test_silhouette_and_inertia_closed_form(spark):
    x, y = cloud(90, 2, 8), np.repeat([0, 1, 2], 30)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    s = []
    for i in range(90):
        a = d[i][y == y[i]].sum() / 29
        b = min(d[i][y == c].mean() for c in range(3) if c != y[i])
        s.append((b - a) / max(a, b) if max(a, b) else 0.0)
    df = frame(spark, x, y)
    assert abs(evaluate.silhouette(df, "v", "y").first()[0] - np.mean(s)) < 1e-9
    want = sum(((x[y == c] - x[y == c].mean(0)) ** 2).sum() for c in range(3))
    assert abs(evaluate.inertia(df, "v", "y").first()[0] - want) < 1e-8


def test_knn_votes(spark):
    x, y = cloud(120, 2, 9), np.arange(120) % 3
    df = frame(spark, x, y)
    train, test = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    got = {r["id"]: r["prediction"] for r in classifiers.knn_classify(train, test, "id", "v", "y", 5).collect()}
    ids = [i for i in range(120) if i % 4]
    for i in range(0, 120, 4):
        near = sorted(ids, key=lambda j: (np.linalg.norm(x[j] - x[i]), j))[:5]
        votes = np.bincount(y[near], minlength=3)
        assert got[i] == votes.argmax()


def test_ties_and_far_values(spark):
    same = spark.createDataFrame([((i * 7919) % 400, 1.0, 2.0) for i in range(400)], "id int, x double, y double")
    got = neighbors.nearest(same, same, "id", ["x", "y"], 3, exclude_self=True).collect()
    for i in (0, 1, 250):
        assert [r["neighbor"] for r in sorted(got, key=lambda r: r["rank"]) if r["id"] == i] == [j for j in range(4) if j != i][:3]
    line = spark.createDataFrame([(i, 1e8 + i / 4) for i in range(200)], "id int, x double")
    got = {(r["id"], r["rank"]): r["neighbor"] for r in neighbors.nearest(line, line, "id", ["x"], 2, exclude_self=True).collect()}
    assert all({got[i, 1], got[i, 2]} == {i - 1, i + 1} for i in range(1, 199)) and got[0, 2] == 2
    apart = spark.createDataFrame([(i, 1e8 + i) for i in range(100)], "id int, x double")
    assert {r["cluster"] for r in cluster.dbscan(apart, "id", ["x"], 0.9, 2).collect()} == {-1}
    assert {r["cluster"] for r in cluster.dbscan(apart, "id", ["x"], 1.0, 2).collect()} == {0}


def test_distances_far_from_the_origin():
    rng = np.random.default_rng(5)
    a, b = 1e6 + rng.normal(size=(40, 12)), 1e6 + rng.normal(size=(50, 12))
    b[0] = a[0]
    b[1] = a[1] + 1e-6
    right = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2))
    assert np.allclose(neighbors._distances(a, b), right, rtol=1e-8, atol=0)
    eps = right[3, 4]
    assert (neighbors.within(a, b, eps) == (right <= eps)).all()


def test_a_visitor_goes_once_to_a_zone(spark):
    """Where bounds rule nothing out, a row's vector is sent once to a zone and not to each of its cells, and a task sends on k rows."""
    x = np.random.default_rng(6).normal(size=(500, 24))
    pts = neighbors.points(frame(spark, x), "id", "v")
    placed, cells = neighbors.build_cells(pts, 1)
    left, right = neighbors._blocks(pts, placed, cells, lambda d, _: np.full(len(d), 100.0), neighbors.BLOCK)
    assert (cells.size > 0).sum() > 5 and left.count() == right.count() == 500
    near = neighbors._near(pts.toPandas(), cells, neighbors._distances(cells.pivots, cells.pivots), lambda d, _: np.full(len(d), 100.0))
    assert all(n.all() for _, n in near)
    left, right = neighbors._blocks(pts, placed, cells, lambda d, _: np.full(len(d), 100.0), 8)
    zones = len(cells.zones(8 * neighbors.ZONE))
    assert 1 < zones < (cells.size > 0).sum() and right.select("id").distinct().count() == 500
    assert left.select("id", "zone", "part").distinct().count() == left.count()


def test_bounds_are_worked_out_in_slices(spark, monkeypatch):
    x = cloud(200)
    pts = neighbors.points(frame(spark, x), "id", "v")
    _, cells = neighbors.build_cells(pts, 4)
    monkeypatch.setattr(neighbors, "SLICE", 20 * cells.closest.size)
    sizes = []
    reach = lambda d, part: sizes.append(len(d)) or np.full(len(d), 0.5)
    rows = [r for r, _ in neighbors._near(pts.toPandas(), cells, neighbors._distances(cells.pivots, cells.pivots), reach)]
    assert max(sizes) == 20 and list(np.concatenate(rows)) == list(range(200))


def test_spanning_forest_is_least():
    rng = np.random.default_rng(7)
    for n, m in ((40, 300), (40, 30), (5, 0)):
        a, b, level = rng.integers(0, n, m), rng.integers(0, n, m), rng.integers(0, 5, m)
        root, want = list(range(n)), []

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i in np.argsort(level, kind="stable"):
            if find(a[i]) != find(b[i]):
                root[find(a[i])] = find(b[i])
                want.append(i)
        assert sorted(cluster.spanning(a, b, level)) == sorted(want)


def test_dbscan_meets_all_rows_once(spark, monkeypatch):
    """Pairs are met once for their count; after it only rows that a few others do not tell to hang together meet all."""
    rng = np.random.default_rng(14)
    x = np.concatenate([rng.normal(size=(330, 6)) * 0.6, rng.normal(size=(60, 6)) * 0.3 + 4, rng.uniform(-6, 6, size=(60, 6))])
    x = np.concatenate([x, x[:20]])
    sent, within = [], cluster._within
    monkeypatch.setattr(cluster, "BLOCK", 16)
    monkeypatch.setattr(cluster, "_within", lambda pts, *a: sent.append((pts.count(), a[-1])) or within(pts, *a))
    for eps, m in ((1.3, 5), (0.9, 4)):
        got = {r["id"]: r["cluster"] for r in cluster.dbscan(frame(spark, x), "id", "v", eps, m).collect()}
        assert [got[i] for i in range(len(x))] == list(brute_dbscan(x, eps, m))
        (all_rows, half), (forest, _), _ = sent[-3:]
        assert (all_rows, half) == (450, True) and 0 < forest < 250


def test_dbscan_leaves_nulls_apart(spark):
    """A row without a value is near to none, itself included."""
    rows = spark.createDataFrame([(i, None if i in (3, 8) else float(i)) for i in range(12)], "id long, x double")
    got = {r["id"]: r["cluster"] for r in cluster.dbscan(rows, "id", ["x"], 1.0, 2).collect()}
    assert got[3] == got[8] == -1 and all(got[i] >= 0 for i in (4, 5, 6, 9, 10, 11))
