import numpy as np
import pytest

from larkspur.llm import topk
from larkspur.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect


def brute(ids, x, asked, k):
    out = set()
    for q in asked:
        score = x @ x[list(ids).index(q)]
        best = sorted((-s, i) for s, i in zip(score, ids) if i != q)[:k]
        out |= {(q, r, i, int(-s)) for r, (s, i) in enumerate(best, 1)}
    return out


def test_whole_table(spark, sf):
    assert compare(spark, connect(sf), "op7", QUERIES["op7_topk"], ORACLES["op7_topk"], sf).startswith("ok")


@pytest.mark.parametrize("kind", ["few dimensions", "ties", "equal", "skewed"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(1)
    x = {
        "few dimensions": rng.integers(-50, 50, (700, 3)), "ties": rng.integers(-1, 2, (700, 6)),
        "equal": np.repeat(rng.integers(-9, 9, (7, 5)), 100, 0), "skewed": (rng.pareto(1.0, (700, 8)) * 5).astype(int),
    }[kind].astype(float)
    ids = rng.permutation(700).tolist()
    df = spark.createDataFrame(list(zip(ids, x.tolist())), "vec_id long, embedding array<double>")
    for rows, per in ((100, 7), (8192, 512)):
        got = {tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 5, rows=rows, per=per).collect()}
        assert got == brute(ids, x, [i for i in ids if i % 50 == 0], 5)


def test_lists_are_not_read_to_the_end():
    """With few components the bounds settle early; the reading stops there."""
    rng = np.random.default_rng(2)
    x = rng.pareto(0.7, (4000, 2)) // 0.01
    order = np.argsort(x.T, axis=1, kind="stable")
    deep = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and isinstance(key[1], slice):
                deep.append(key[1])
            return super().__getitem__(key)

    at, score = topk.best(order.view(Watched), np.take_along_axis(x.T, order, 1), np.array([3.0, 1.0]), 5)
    full = x @ [3, 1]
    assert {*np.argsort(-full)[:5]} <= {*np.asarray(at).tolist()} and np.allclose(full[np.asarray(at)], score)
    assert 0 < len(deep) <= 8


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [1.0, 1.0]), (6, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", topk.F.lit("x")).withColumn("id", topk.F.lit("x"))
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id = 0"), 5).collect())
    assert got == [(0, 1, 5, 3), (0, 2, 6, -1)]
    assert topk.top_k(df.limit(0), df, 5).count() == 0 and topk.top_k(df, df.limit(0), 5).count() == 0


def plain(rows, k):
    """The contract over (id, vector) rows: distinct rows, own length only, ties to the smaller id."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = []
    for q in sorted({i for i, _ in rows if i % 50 == 0}):
        scored = [(-int(np.dot(a, v)), j) for i, a in rows if i == q for j, v in rows if j != q and len(v) == len(a)]
        out += [(q, r, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_an_id_with_several_vectors(spark):
    """The query's own rows, however many, take no other row's place."""
    rng = np.random.default_rng(4)
    rows = [(0, [9.0 + i, 9.0]) for i in range(4)] + [(i, rng.integers(-5, 6, 2).astype(float).tolist()) for i in range(1, 9)] + [(50, [1.0, -3.0]), (50, [-2.0, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (3, 8192):
        got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 5, rows=block).collect())
        assert got == plain(rows, 5)


def test_vectors_of_several_lengths(spark, monkeypatch):
    monkeypatch.setattr(topk, "WAVE", 1)
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-20, 20, 2 + i % 3).astype(float).tolist()) for i in range(300)]
    df = spark.createDataFrame([*rows, (301, []), (350, [])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 5, rows=60, per=3).collect())
    assert got == plain(rows, 5)
