"""Ward's linkage against merging the cheapest pair each time."""

import numpy as np
import pytest

from larkspur.models import linkage


def plain(x):
    """[(a, b, height)] by going through all pairs for every merge."""
    at = {i: (np.array(v, float), 1) for i, v in enumerate(x)}
    out = []
    while len(at) > 1:
        ids = sorted(at)
        v, n = np.array([at[i][0] for i in ids]), np.array([at[i][1] for i in ids], float)
        cost = ((v[:, None] - v[None]) ** 2).sum(2) * (n[:, None] * n[None] / (n[:, None] + n[None]))
        cost[np.tril_indices(len(ids))] = np.inf
        i, j = np.unravel_index(cost.argmin(), cost.shape)
        a, b = ids[i], ids[j]
        out.append((a, b, float(np.sqrt(2 * cost[i, j]))))
        at[a] = ((n[i] * v[i] + n[j] * v[j]) / (n[i] + n[j]), int(n[i] + n[j]))
        del at[b]
    return out


def frame(spark, x):
    return spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id long, v array<double>")


def parts(labels):
    return sorted(sorted(i for i, c in labels.items() if c == k) for k in set(labels.values()))


def plain_parts(merges, n, k):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b, _ in sorted(merges, key=lambda m: (m[2], m[1], m[0]))[: n - k]:
        root[find(b)] = find(a)
    return parts({i: find(i) for i in range(n)})


@pytest.mark.parametrize("block,dim", [(70, 2), (110, 12), (2048, 2)])
def test_merges_and_cuts(spark, block, dim):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(80, dim)), rng.normal(size=(60, dim)) * 0.5 + 3, rng.uniform(-4, 6, size=(20, dim))])
    df = frame(spark, x)
    want = plain(x)
    merges = linkage.settle(linkage.ward_merges(df, "id", "v", block=block))
    got = sorted((r["a"], r["b"], r["height"]) for r in merges.collect())
    assert [(a, b) for a, b, _ in got] == sorted((a, b) for a, b, _ in want)
    assert np.allclose([h for *_, h in got], [h for *_, h in sorted(want)], rtol=1e-9)
    cut = linkage.cut_tree(merges, df, "id", range(1, 11)).collect()
    for k in range(1, 11):
        labels = {r["id"]: r["cluster"] for r in cut if r["k"] == k}
        assert parts(labels) == plain_parts(want, len(x), k)
        first = [min(i for i, c in labels.items() if c == j) for j in range(k)]
        assert first == sorted(first)


def test_equal_rows_and_lattice(spark):
    """Ties: a lattice has many trees, but each ends in one cluster, merges n - 1 times and never falls in height."""
    x = [[i % 7, i // 7] for i in range(49)] + [[0, 0]] * 20 + [[3, 3]] * 5
    df = frame(spark, x)
    merges = linkage.settle(linkage.ward_merges(df, "id", "v", block=25))
    got = [(r["a"], r["b"], r["height"]) for r in merges.collect()]
    assert len(got) == len(x) - 1 and sum(h == 0 for *_, h in got) == 25
    assert len({b for _, b, _ in got}) == len(got)
    last = {}
    for a, b, h in sorted(got, key=lambda m: m[2]):
        assert last.get(a, 0) <= h and last.get(b, 0) <= h
        last[a] = h
    labels = {r["id"]: r["cluster"] for r in linkage.cut_tree(merges, df, "id", [4]).collect()}
    assert len(labels) == len(x) and set(labels.values()) == {0, 1, 2, 3}


def test_one_row_and_none(spark):
    one = frame(spark, [[1.0, 2.0]])
    assert linkage.ward_merges(one, "id", "v").count() == 0
    assert [tuple(r) for r in linkage.cut_tree(linkage.ward_merges(one, "id", "v"), one, "id", [1, 2]).collect()] == [(0, 1, 0), (0, 2, 0)]
    assert linkage.ward_merges(one.limit(0), "id", "v").count() == 0
    odd = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, None), (3, [None]), (4, [float("nan")])], "id long, v array<double>")
    assert [tuple(r) for r in linkage.ward_merges(odd, "id", "v").collect()] == [(0, 1, 1.0)]


@pytest.mark.parametrize("block,dim,rounds", [(20, 24, 0), (8, 2, 3)])
def test_a_zone_of_clusters_takes_no_round(spark, monkeypatch, block, dim, rounds):
    """In many dimensions a round merges few pairs: the tree of a zone's clusters must not wait for them."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, dim)) * rng.uniform(0.5, 2, size=(120, 1)) + 1e5
    seen, partners = [], linkage._partners
    monkeypatch.setattr(linkage, "_partners", lambda c, block: seen.append(c.count()) or partners(c, block))
    merges = linkage.ward_merges(frame(spark, x), "id", "v", block=block).collect()
    assert sorted((r["a"], r["b"]) for r in merges) == sorted((a, b) for a, b, _ in plain(x))
    assert min(rounds, 1) <= len(seen) <= rounds and all(n > block * linkage.ZONE for n in seen)


def test_chain_far_from_the_origin_and_infinite():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(90, 6)), 1) * 1e-3 + 1e4 * np.arange(90)[:, None] // 30
    got = sorted((int(a), int(b), float(np.sqrt(2 * c))) for a, b, c in linkage._chain(np.arange(90), x, np.ones(90)))
    want = sorted(plain(x))
    assert [m[:2] for m in got] == [m[:2] for m in want] and np.allclose([h for *_, h in got], [h for *_, h in want], rtol=1e-9)
    far = np.array([[0.0, 1.0], [np.inf, 0.0], [0.0, 1.5]])
    assert [(int(a), int(b)) for a, b, _ in linkage._chain(np.arange(3), far, np.ones(3))] == [(0, 2), (0, 1)]


@pytest.mark.parametrize("held", [0, 1 << 26])
def test_only_clusters_that_lost_their_partner_look_again(spark, monkeypatch, held):
    """A merge brings nothing closer, so a round looks for the partners that the merges before it took away, and not for all."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(90, 6)) * rng.uniform(0.5, 2, size=(90, 1)) + 50
    asked, partners, cheapest = [], linkage._partners, linkage._cheapest
    monkeypatch.setattr(linkage, "HELD", held)
    monkeypatch.setattr(linkage, "_partners", lambda c, block, some=None: asked.append((c.count(), some and some.count())) or partners(c, block, some))
    got = sorted((r["a"], r["b"], r["height"]) for r in linkage.ward_merges(frame(spark, x), "id", "v", block=6).collect())
    want = sorted(plain(x))
    assert [m[:2] for m in got] == [m[:2] for m in want] and np.allclose([h for *_, h in got], [h for *_, h in want], rtol=1e-9)
    assert asked[0] == (90, None) and all(some < many for many, some in asked[1:]) and (len(asked) > 1) == (not held)
    # the kernel tells pairs apart that single precision does not
    n, ids = rng.integers(1, 9, 40), np.arange(40)
    for y in (x[:40], 1e6 + x[:40] * 1e-3, np.round(x[:40]) * 1e5, x[:40] * 1e-60):
        cost = ((y[:, None] - y[None]) ** 2).sum(2) * (n[:, None] * n[None] / (n[:, None] + n[None]))
        np.fill_diagonal(cost, np.inf)
        row, place, low = cheapest(y, y, n, n, ids, ids)
        assert (row == ids).all() and (low == cost.min(1)).all() and (cost[row, place] == low).all()
