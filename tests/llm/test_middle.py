import hashlib
import random
import re

import numpy as np
import pytest

from larkspur.llm import middle
from larkspur.llm.queries import QUERIES
from tests.llm import brute

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, rate=50, suffix_first=80):
    """(n, form, prefix code points, middle code points, output)"""
    text = text or ""
    u = UNIT.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i: 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(u) + 1) for x in h[:2])
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_cuts_equal_the_pattern():
    rng = random.Random(2)
    for _ in range(500):
        texts = ["".join(rng.choice("ab \t\n\x0b\x0c\ré€\U0001D11E\x08\x0e\x1f!\x00 　\x7f") for _ in range(rng.choice([0, 0, 1, 2, 5, 9, 30]))) for _ in range(rng.randint(1, 8))]
        data = [t.encode() for t in texts]
        end = np.cumsum([len(x) for x in data])
        start = end - [len(x) for x in data]
        h = np.array([[rng.randrange(2**32) for _ in texts] for _ in range(2)])
        whole = np.frombuffer(b"".join(data), np.uint8)
        n, i, j, prefix, mid = middle.cut(whole, start, end, *h)
        for k, t in enumerate(texts):
            u = UNIT.findall(t)
            a, b = sorted(int(x) % (len(u) + 1) for x in h[:, k])
            p, m = "".join(u[:a]), "".join(u[a:b])
            assert (n[k], prefix[k], mid[k]) == (len(u), len(p), len(m))
            assert whole[start[k]: i[k]].tobytes() == p.encode() and whole[i[k]: j[k]].tobytes() == m.encode()


def test_every_byte_value():
    data = np.arange(256, dtype=np.uint8)
    want = [b in b" \t\n\x0b\x0c\r" for b in range(256)]
    assert ((middle.white(middle.words_of(data)).view(np.uint8) == 0x80) == want).all()


def test_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op12_fill_in_middle"](spark, sf)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = set()
    for d, t in rows:
        *head, text = plain(d, t)
        want.add((d, *head, brute.sha(text.encode()), brute.sha((t or "").encode())))
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows) and set(got) == want
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_odd_rows(spark):
    """Null and empty texts, null ids, marks in texts and parts of marks at every cut, repeated rows, long texts,
    clashing columns, an empty table. Every output goes back to its text."""
    rng = random.Random(8)
    texts = [None, "", " ", "a", "a <P>b", "<M>", "x<S", "< <P <S <M > P> <<S " * 3, "é €\n" * 50, "word " * 60_000]
    texts += [" ".join(rng.choice(["<", "<P", "S>", "<S", "M", ">", "<M", "P>", "\U0001D11E"]) for _ in range(12)) for _ in range(300)]
    rows = [(i if i != 6 else None, t, "n", 7) for i, t in enumerate(texts)] + [(9, texts[9], "m", 8)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, h1 int")
    for rate, first in ((50, 80), (100, 0), (100, 100)):
        out = middle.fill_in_middle(df, rate=rate, suffix_first=first)
        out = out.withColumn("back", middle.restored(middle.F.col("output"), middle.F.col("form")))
        got = sorted((tuple(r) for r in out.collect()), key=lambda r: tuple(map(str, r)))
        want = [(d, *plain(d, t, rate, first), t or "") for d, t, *_ in rows]
        assert got == sorted(want, key=lambda r: tuple(map(str, r)))
    assert middle.fill_in_middle(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        middle.fill_in_middle(df, marks=("<P>", "<S>", "P>"))
