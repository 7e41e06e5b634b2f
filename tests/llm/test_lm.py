import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from larkspur.llm import lm
from larkspur.llm.queries import QUERIES
from tests.llm import brute


def plain(rows):
    """{(doc_id, text): (held_out, n_tokens, n_known, N, base)}"""
    cut = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", brute.lower((t or "").encode())) + [b"\n"]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, t in rows if not out(d) for w in cut(t))
    n, v = sum(c.values()), len(c)
    return {(d, t): (out(d), len(cut(t)), sum(c[w] > 0 for w in cut(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in cut(t))) for d, t in rows}


def check(out, rows, by):
    want = plain(rows)
    assert len(out) == len(rows)
    for r in out:
        held, tokens, known, n, base = want[by(r)]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    text = dict(rows)
    out = QUERIES["op9_lm_score"](spark, sf).collect()
    check(out, rows, lambda r: (r["doc_id"], text[r["doc_id"]]))
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("docs", [3, 4096])
def test_ranges_chunks_and_odd_rows(spark, monkeypatch, docs):
    """Several key ranges and small chunks; nulls, repeated rows, a long text, clashing columns."""
    rows = [(i, " ".join(f"W{(i * j) % 17}" for j in range(i % 9))) for i in range(60)]
    rows += [(1, ""), (2, None), (3, "a b a b"), (3, "a b a b"), (None, "a b a"), (99, "word " * 60_000)]
    monkeypatch.setattr(lm, "CHUNK_DOCS", docs)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", lm.F.lit(1)).withColumn("digest", lm.F.lit(1)).repartition(3)
    out = lm.lm_scores(df, filter_bytes=1 << 16, range_bytes=50_000).withColumn("n", lm.F.monotonically_increasing_id()).collect()
    want = plain(rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out) == sorted((str(d), *want[d, t][:4], round(want[d, t][4], 6)) for d, t in rows)
    assert lm.lm_scores(df.limit(0)).count() == 0
    one = [r for r in out if r["doc_id"] == 3]
    assert len({r["score"] for r in one if r["n_tokens"] == 5}) == 1


def test_filter_levels():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << lm.KEY_BITS, 20_000, dtype=np.uint64))
    counts = rng.zipf(1.5, len(keys)) % 100_000 + 1
    bits = 1 << 20
    part = np.zeros(bits // 8, np.uint8)
    lm.set_bits(keys, counts, bits, part)
    f = lm.Filter(part.tobytes(), 1)
    level = f.level(keys)
    true = lm.levels_of(counts)
    assert (level >= true).all() and (level == true).mean() > 0.97
    other = rng.integers(0, 1 << lm.KEY_BITS, 20_000, dtype=np.uint64)
    assert (f.level(other) > 0).mean() < 0.03
    assert lm.levels_of(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4] and lm.middle(np.array([0, 1, 2])).tolist() == [0, 1, 2.5]


def levels_score(rows):
    """{text: score} from plain level counts, without a filter."""
    cut = lambda t: t.encode().lower().split() + [b"\n"]
    train = [cut(t) for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    one, two = Counter(w for ws in train for w in ws), Counter(p for ws in train for p in zip([b"\n", *ws], ws))
    n, v = sum(one.values()), len(one)
    mid = lambda c: (1.5 * 2 ** c.bit_length() - 1) / 2 if c else 0.0

    def p(a, b):
        low = (mid(one[b]) + 1) / (n + v + 1)
        return lm.MIX * min(1.0, mid(two[a, b]) / mid(one[a])) + (1 - lm.MIX) * low if one[a] else low

    return {t: sum(math.log10(p(a, b)) for a, b in zip([b"\n", *cut(t)], cut(t))) for _, t in rows}


def test_score_near_plain_levels(spark):
    """The filter grows with its entries, past what the bound of one segment holds."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 40) % 3000)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, text = levels_score(rows), dict(rows)
    out = lm.lm_scores(df, filter_bytes=4_000, range_bytes=10_000).collect()
    assert len(out) == len(rows)
    off = np.array([r["score"] - want[text[r["doc_id"]]] for r in out])
    assert abs(off.mean()) < 0.01 * abs(np.mean(list(want.values()))) and np.median(abs(off)) < 0.5
    with pytest.raises(Exception, match="range_bytes"):
        lm.lm_scores(df, filter_bytes=100, range_bytes=10_000).count()


def filter_score(rows, range_bytes):
    """{text: score}, with every segment rebuilt as a set of bit places and probed entry by entry, on plain integers."""
    full, k1, k2, k3 = (1 << 64) - 1, int(lm.K1), int(lm.K2), int(lm.K3)

    def mixed(x):
        x = ((x ^ x >> 29) * k2) & full
        return ((x ^ x >> 32) * k1) & full

    h = lambda w: xxhash.xxh3_64_intdigest(w)
    cut = lambda t: (t or "").encode().lower().split() + [b"\n"]
    word = lambda w: mixed(h(w)) >> 64 - lm.KEY_BITS
    pair = lambda a, b: mixed((h(a) * k3 + h(b)) & full) >> 64 - lm.KEY_BITS
    place = lambda key, level, i, bits: (mixed((key + level * k1 + i * k3) & full) >> 32) * bits >> 32
    train = [cut(t) for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    one, two = Counter(w for ws in train for w in ws), Counter(p for ws in train for p in zip([b"\n", *ws], ws))
    n, v = sum(one.values()), len(one)
    ranges = -(-sum(len((t or "").encode()) for _, t in rows) // range_bytes)
    entries = [(word(w), c) for w, c in one.items()] + [(pair(*p), c) for p, c in two.items()]
    segments = []
    for r in range(ranges):
        mine = [(k, c.bit_length()) for k, c in entries if k * ranges >> lm.KEY_BITS == r]
        bits = 8 * max(1, -(-sum(top for _, top in mine) * lm.ENTRY_BITS // 8))
        segments.append((bits, {place(k, level, i, bits) for k, top in mine for level in range(1, top + 1) for i in range(lm.PROBES)}))

    def mid(key):
        bits, there = segments[key * ranges >> lm.KEY_BITS]
        level = 0
        while all(place(key, level + 1, i, bits) in there for i in range(lm.PROBES)):
            level += 1
        return (1.5 * 2**level - 1) / 2 if level else 0.0

    def chance(a, b):
        low, seen = (mid(word(b)) + 1) / (n + v + 1), mid(word(a))
        return lm.MIX * min(1.0, mid(pair(a, b)) / seen) + (1 - lm.MIX) * low if seen else low

    return {t: sum(math.log10(chance(a, b)) for a, b in zip([b"\n", *cut(t)], cut(t))) for _, t in rows}


def test_score_equals_the_filter_rebuilt(spark, monkeypatch):
    """False hits of the filter included: the score of every row, over several ranges and chunks."""
    monkeypatch.setattr(lm, "CHUNK_DOCS", 32)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"W{x}" for x in rng.zipf(1.4, rng.integers(0, 30)) % 400)) for i in range(300)]
    rows += [(300, None), (None, "w1 w2 w1"), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, by = filter_score(rows, 3_000), {}
    for d, t in rows:
        by.setdefault(d, set()).add(t)
    out = lm.lm_scores(df, range_bytes=3_000).collect()
    assert len(out) == len(rows)
    for r in out:
        (t,) = by[r["doc_id"]]
        assert r["score"] == pytest.approx(want[t], rel=1e-9, abs=1e-9)
