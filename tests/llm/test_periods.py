import random
import zlib

import numpy as np
import pytest

from larkspur.llm import periods
from larkspur.llm.queries import QUERIES
from tests.llm import brute


def plain_runs(w, copies=4, least=6):
    """Every maximal stretch of every period, the smallest period of each, by going through all words for each lag."""
    best = {}
    for q in range(1, len(w) // copies + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - a + q >= max(least, copies * q):
                best.setdefault((a, i - a + q), q)
    return sorted((a, n, q) for (a, n), q in best.items())


def plain_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def made(rng):
    w, k, n = [], rng.choice([1, 2, 3, 5, 20]), rng.randint(0, 120)
    while len(w) < n:
        if rng.random() < 0.5:
            p = [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 12))]
            w += [p[i % len(p)] for i in range(rng.randint(1, 70))]
        else:
            w += [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 20))]
    return w


def test_runs_equal_the_plain_scan():
    rng, total = random.Random(3), 0
    for _ in range(600):
        texts = [made(rng) for _ in range(rng.randint(1, 5))]
        for w, got in zip(texts, periods.runs_of(texts)):
            want = plain_runs(w)
            total += len(want)
            assert got == want, w
            assert periods.collapse(w, got) == plain_collapse(w, want)
    assert total > 1000


def test_only_hashes_may_clash(monkeypatch):
    """With a block hash that says nothing the answers are the same: hits are compared word by word."""
    monkeypatch.setattr(periods, "BASE", np.uint64(0))
    rng = random.Random(4)
    for _ in range(100):
        w = made(rng)
        assert periods.runs_of([w])[0] == plain_runs(w)


def test_small_pieces_and_cells(monkeypatch):
    monkeypatch.setattr(periods, "LAG_CELLS", 7)
    rng = random.Random(5)
    texts = [made(rng) for _ in range(60)]
    assert periods.runs_of(texts) == [plain_runs(w) for w in texts]


def test_splitting_leaves_stable_segments():
    code = np.array([1, 1, 1, 1, 1, 1, 9, 2, 3, 2, 3, 2, 3, 2, 3, 8, 2, 3, 2])
    assert periods.split_rare(code, np.zeros(len(code), int)) == [(0, 6), (7, 15)]  # the tail has too few once cut off
    assert periods.split_rare(np.array([1, 1, 1, 2, 1, 1, 1]), np.array([0, 0, 0, 1, 1, 1, 1])) == []


def test_long_text_of_few_words():
    w = [b"a", b"b"] * 40_000 + [b"c"] + [b"d"] * 40_000
    assert periods.runs_of([w])[0] == [(0, 80_000, 2), (80_001, 40_000, 1)]


def digest(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = plain_runs(w)
    top = None
    for s, n, q in runs:
        if top is None or n * top[2] > top[1] * q:
            top = (s, n, q)
    row = (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None)
    return (*row, brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), brute.sha(b" ".join(plain_collapse(w, runs))))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op11_periodic_runs"](spark, sf)
    assert out.columns == COLUMNS
    got = sorted(tuple(r) for r in out.collect())
    want = sorted(digest(*r) for r in rows)
    assert got == want and sum(r[1] > 0 for r in want) > 10


def test_odd_rows(spark, tmp_path):
    """Null and empty texts, null ids, repeated rows, ties of exponent, white space of all kinds, words beyond ASCII,
    clashing columns, an empty table."""
    texts = [None, "", " \n", "x", "a " * 5, "a " * 6, "a b " * 4 + "c " + "d e " * 4, "é\t" * 7 + " ", "a b " * 6, "a\x0bb\x0cc\r\n" * 9, "a " * 7]
    rows = [(i if i != 3 else None, t, [1], "r") for i, t in enumerate(texts)] + [(5, "a " * 6, [2], "q")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs array<int>, collapsed string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=key)
    assert got == sorted((digest(r[0], r[1]) for r in rows), key=key)
    assert any(r[0] == 6 and r[1:5] == (2, 0, 8, 2) for r in got)  # equal exponents: the earlier run
    assert periods.find_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.find_runs(df, copies=3)
