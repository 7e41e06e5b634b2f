"""Density sweeps against one plain run per pair."""

from collections import Counter

import numpy as np
import pytest

from __spark_entry__ import queries
from larkspur.models import density, forest


def plain(x, epss, ms):
    """{(eps, m): (component of each core row or -1, clusters, noise rows)} by breadth-first search."""
    d, out = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), {}
    for e in epss:
        for m in ms:
            near = d <= e
            core = near.sum(1) >= m
            seen, k = np.full(len(x), -1), 0
            for i in np.flatnonzero(core):
                if seen[i] >= 0:
                    continue
                stack, seen[i] = [i], k
                while stack:
                    for j in np.flatnonzero(near[stack.pop()] & core & (seen < 0)):
                        seen[j] = k
                        stack.append(j)
                k += 1
            out[e, m] = seen, k, int((~core & ~(near & core[None]).any(1)).sum())
    return out


def rand(y, c):
    two = lambda v: sum(n * (n - 1) / 2 for n in v)
    both, a, b, n = two(Counter(zip(y, c)).values()), two(Counter(y).values()), two(Counter(c).values()), len(y)
    want, top = (a * b / (n * (n - 1) / 2), (a + b) / 2) if n > 1 else (0, 0)
    return 1.0 if top == want else (both - want) / (top - want)


def check(got, x, y, epss, ms):
    got = {(r["eps"], r["min_samples"]): r for r in got}
    want = plain(x, epss, ms)
    assert set(got) == set(want)
    for at, (seen, k, noise) in want.items():
        r, core = got[at], seen >= 0
        assert (r["clusters"], r["noise"], r["core_rows"]) == (k, noise, core.sum()), at
        assert r["ari"] is None if not core.any() else abs(r["ari"] - rand(y[core].tolist(), seen[core].tolist())) < 1e-9


def cloud():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(110, 3)) * 0.4, rng.normal(size=(90, 3)) * 0.3 + 2, rng.uniform(-3, 4, size=(50, 3))])
    return np.concatenate([x, x[:30], x[:1].repeat(4, 0)])  # equal rows


def frame(spark, x, y):
    return spark.createDataFrame([(i, [float(a) for a in r], int(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, v array<double>, y int")


def test_sweep_equals_a_run_per_pair(spark, monkeypatch):
    calls = []
    compare = density._compare
    monkeypatch.setattr(density, "_compare", lambda *a: calls.append(1) or compare(*a))
    x = cloud()
    y = np.arange(len(x)) % 3
    epss, ms = [0.8, 0.15, 0.45], [2, 3, 5, 10]
    check(density.sweep_dbscan(frame(spark, x, y), "id", "v", epss, ms, label="y", block=64).collect(), x, y, epss, ms)
    assert len(calls) == 2  # distances are worked out twice, whatever the grid


def test_distances_on_the_border_and_all_noise(spark):
    x = np.array([[0.0], [1.0], [2.0], [10.0]])
    epss, ms = [1.0, 0.5], [1, 2, 3]
    check(density.sweep_dbscan(frame(spark, x, [0, 0, 1, 1]), "id", "v", epss, ms, label="y").collect(), x, np.array([0, 0, 1, 1]), epss, ms)
    with pytest.raises(ValueError):
        density.sweep_dbscan(frame(spark, x, [0] * 4), "id", "v", [], ms)


def test_least_forest_is_a_least_spanning_forest():
    """Components at every level are those of all edges."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        n, m, top = rng.integers(1, 9), rng.integers(1, 9), 5
        link = rng.integers(0, top + 4, size=(n, m)).astype(np.int8)
        i, j, at = density.least_forest(link, top)
        assert (at < top).all() and len(i) < n + m and (link[i, j] == at).all()

        def parts(edges):
            root = list(range(n + m))

            def find(a):
                while root[a] != a:
                    a = root[a]
                return a

            for a, b in edges:
                root[find(a)] = find(b + n)
            return [[find(a) == find(b) for b in range(n + m)] for a in range(n + m)]

        for level in range(top):
            assert parts(zip(*np.nonzero(link <= level))) == parts((a, b) for a, b, k in zip(i, j, at) if k <= level)


def test_vectors_query(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in e], dtype=np.float64)
    check(queries()["tun7_sweep_dbscan_vectors"](spark, sf).collect(), x, np.array([r["label"] for r in e]), [0.1 + 1.9 / 9 * i for i in range(10)], [2, 3, 5, 10])


def test_roots_by_level(spark):
    """Each level's roots from its own edges equal the components of all edges up to it."""
    rng = np.random.default_rng(8)
    links = [(int(k), int(rng.integers(0, 4)), *map(int, rng.choice(60, 2, replace=False))) for k in (0, 1) for _ in range(70)]
    df = spark.createDataFrame(links, "k int, level int, a long, b long")
    got = density.level_roots(df, 4).collect()
    for k in (0, 1):
        for level in range(4):
            told = {r["id"]: r["root"] for r in sorted(got, key=lambda r: r["level"]) if r["k"] == k and r["level"] <= level}
            want = list(range(60))
            for _ in range(60):
                for kk, lev, a, b in links:
                    if kk == k and lev <= level:
                        want[a] = want[b] = min(want[a], want[b])
            assert [told.get(i, i) for i in range(60)] == want


def test_rows_known_to_hang_together_do_not_meet_all(spark, monkeypatch):
    rng = np.random.default_rng(15)
    x = np.concatenate([rng.normal(size=(260, 6)) * 0.6, rng.normal(size=(50, 6)) * 0.3 + 4, rng.uniform(-6, 6, size=(30, 6))])
    x = np.concatenate([x, x[:40] + 1e-3, x[:15]])
    y = np.arange(len(x)) % 4
    sent, blocks = [], density._blocks
    monkeypatch.setattr(density, "_blocks", lambda pts, *a: sent.append(pts.count()) or blocks(pts, *a))
    epss, ms = [0.05, 0.7, 1.4, 4.0], [2, 4]
    check(density.sweep_dbscan(frame(spark, x, y), "id", "v", epss, ms, label="y", block=16).collect(), x, y, epss, ms)
    assert sent[0] == 380 and 0 < sent[1] < 330


def test_counts_and_known_links():
    """Counts for both sides, and a least forest that leaves out what is known to hang together."""
    rng = np.random.default_rng(16)
    a, b = rng.normal(size=(300, 9)) * 0.3, rng.normal(size=(77, 9)) * 0.3
    b[:40] = a[:40] + 1e-4
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    epss = np.sort(np.append(np.quantile(d, [0.001, 0.2, 0.9]), [d[5, 6], 9.0]))
    wa, wb = rng.integers(1, 4, 300), rng.integers(1, 3, 77)
    for far in (0.0, 1e4):
        lev = forest.levels(a + far, b + far, epss)
        right = np.searchsorted(epss, np.sqrt((((a + far)[:, None] - (b + far)[None]) ** 2).sum(2)))
        assert (lev == right).all()
        of_a, of_b = forest.neighbour_counts(a + far, b + far, wa, wb, epss, True)
        for i in range(len(epss)):
            assert (of_a[:, i] == (right <= i) @ wb).all() and (of_b[:, i] == wa @ (right <= i)).all()
    top = 4
    for few in (0, 1 << 16):
        forest.FEW, held = few, forest.FEW
        for _ in range(100):
            n, m = rng.integers(1, 12, 2)
            link = rng.integers(0, top + 3, size=(n, m)).astype(np.int8)
            since = rng.integers(0, 2 * top, size=n + m).astype(np.int8)
            i, j, at = forest.least_forest(link, top, (since[:n], since[n:]))
            for level in range(top):
                roots = []
                for edges in (zip(*np.nonzero(link <= level)), zip(i[at <= level], j[at <= level])):
                    root, tied = np.arange(n + m), np.flatnonzero(since <= level)
                    e = np.array([(p, q + n) for p, q in edges] + [(tied[0], t) for t in tied]).reshape(-1, 2).astype(int)
                    forest.hang(root, e[:, 0], e[:, 1])
                    roots.append([[p == q for p in root] for q in root])
                assert roots[0] == roots[1]
        forest.FEW = held
