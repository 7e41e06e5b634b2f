import random

import pytest

from larkspur.llm import repeats
from larkspur.llm.queries import QUERIES
from tests.llm import brute


def check(spark, texts, size=400, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kept", repeats.F.lit(1)).withColumn("dk", repeats.F.lit(1))
    rows = {r["doc_id"]: r for r in repeats.remove_repeats(df, size, **kw).collect()}
    want = brute.repeats(texts, size)
    assert len(rows) == len(texts)
    for i, (kept, n, gone) in enumerate(want):
        assert (bytes(rows[i]["kept"]), len(rows[i]["spans"]), sum(s["end"] - s["start"] for s in rows[i]["spans"])) == (kept, n, gone), i


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = {r["doc_id"]: r for r in QUERIES["op5_repeats"](spark, sf).collect()}
    want = brute.repeats([t for _, t in rows], 400)
    assert len(out) == len(rows)
    for (d, t), (kept, n, gone) in zip(rows, want):
        r = out[d]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(t.encode()), gone, n, brute.sha(kept))


def passages(seed, alphabet):
    """Documents cut from shared passages, with edits: repeats of 390 to 900 bytes at all offsets."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    pool = [word(rng.randint(390, 900)) for _ in range(12)]
    out = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            x = rng.choice(pool)
            if rng.random() < 0.4:
                x = x[rng.randint(0, 60): len(x) - rng.randint(0, 60)]
            if rng.random() < 0.2:
                i = rng.randrange(len(x))
                x = x[:i] + word(1) + x[i + 1:]
            parts += [x, word(rng.randint(0, 300))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("hot", [3, 200_000])
def test_passages(spark, hot):
    check(spark, passages(1, "abcdefgh é"), hot=hot, runs=100)


@pytest.mark.parametrize("size", [64, 240, 264])
def test_other_sizes(spark, size):
    check(spark, passages(6, "abcdefgh é"), size=size, runs=200)


def test_copies_are_cut_once(spark, monkeypatch):
    """Segments of a text that many rows hold reach the column-wise step once."""
    rng = random.Random(9)
    x, y = ("".join(rng.choice("abcdef ") for _ in range(1500)) for _ in range(2))
    settled = []
    monkeypatch.setattr(repeats, "settle", lambda df: settled.append(out := df.cache()) or out)
    check(spark, [x] * 40 + [x[:700] + "Q" + x[700:], y])
    segments = next(d for d in settled if "bytes" in d.columns)
    assert segments.count() == segments.distinct().count()


def test_few_symbols(spark):
    check(spark, passages(2, "ab"), size=300)


def test_odd_rows(spark):
    """Null, empty and short texts, equal texts and rows, one long text of one symbol, edges at 399 and 400 bytes."""
    rng = random.Random(5)
    x = "".join(rng.choice("abcdef ") for _ in range(400))
    check(spark, [None, "", "short", "short", x[:399], "z" + x[:399], x + "1", "2" + x, "a" * 3000, "b" * 400, "ab" * 500, "x" * 120 + x[:200] * 3])
    rows = spark.createDataFrame([(1, x), (1, x), (None, x), (2, None)], "doc_id long, text string")
    assert sorted(map(str, repeats.remove_repeats(rows).select("doc_id", repeats.F.length("kept").alias("n")).collect())) == sorted(["Row(doc_id=1, n=0)"] * 2 + ["Row(doc_id=None, n=0)", "Row(doc_id=2, n=0)"])
    assert repeats.remove_repeats(rows.limit(0)).count() == 0


def test_long_texts_are_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 500)
    x = repeats.np.random.default_rng(1).integers(0, 4, 3000).astype("u1")
    p, s0, s1 = repeats.anchor_runs(x)
    assert s0[0] == 0 and s1[-1] == 2600 and (s0[1:] == s1[:-1] + 1).all() and ((p >= s1) & (p < s0 + 256)).all()


def twins(group, p, segments, size):
    """{(offset, run): whether its window equals another's of its group}, by comparing all."""
    at = {(o, i): s[p[i] - o: p[i] - o + size] for i, s in enumerate(segments) for o in range(p[i] + 1) if len(s) >= p[i] - o + size}
    return {(o, i): any(k != i and q == o and group[k] == group[i] and other == w for (q, k), other in at.items()) for (o, i), w in at.items()}


def found_twins(group, p, segments, size):
    return {(o, i): bool(t) for o, who, twin in repeats.columns(repeats.np.array(group), repeats.np.array(p), segments, size) for i, t in zip(who.tolist(), twin.tolist())}


def test_nul_bytes_at_passage_ends():
    """A run that has not begun differs from one with byte 0: the middle run is a byte shorter than its neighbours."""
    segments = [b"abcdefg\0", b"abcdefg", b"abcdefg\0"]
    assert found_twins([0] * 3, [0] * 3, segments, 8) == {(0, 0): True, (0, 2): True}
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(2, 7)
        p = [rng.randint(0, 3) for _ in range(n)]
        segments = [bytes(rng.choice(b"\0\0a") for _ in range(p[i] + rng.randint(5, 9))) for i in range(n)]
        group = [rng.randint(0, 1) for _ in range(n)]
        assert found_twins(group, p, segments, 5) == twins(group, p, segments, 5)
