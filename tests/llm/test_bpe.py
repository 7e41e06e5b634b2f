import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larkspur.llm import bpe
from larkspur.llm.queries import QUERIES
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def digest(t, text):
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha(t.decode(ids, skip_special_tokens=False).encode())


def test_whole_table(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    out = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op6_bpe"](spark, sf).collect()}
    assert out == {r["doc_id"]: digest(plain, r["text"]) for r in docs}


ALPHABETS = ["ab cd   ef  ", "aé ñß\n\t ", "a1 '!s  t", "日本 語a  ", "a \x85\xa0 b", "🙂a  b ́", "ä  \n\n b'll ", " "]


def test_joins_agree_with_the_whole(plain):
    """Cuts before every space: chunks and repairs give what the library gives for the whole text."""
    c, rng = bpe.Codec(PATH), random.Random(1)
    for _ in range(1500):
        letters = rng.choice(ALPHABETS)
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))
        if rng.random() < 0.2:
            at = rng.randint(0, len(text))
            text = text[:at] + "<|endoftext|>" + text[at:]
        for one_in in (1, 3):
            ids = c.encode(text.encode(), one_in)
            want = plain.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want, (text, one_in)
            assert c.decode(ids) == plain.decode(want, skip_special_tokens=False)


def test_chunks_are_shared_and_forgotten(monkeypatch, plain):
    c = bpe.Codec(PATH)
    text = " ".join(f"word{i} and so on" for i in range(2000))
    c.encode(text.encode())
    n = len(c.memory)
    c.encode(("Another start. " + text).encode())
    assert 5 < n < len(c.memory) <= n + 2
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    c = bpe.Codec(PATH)
    assert c.encode(text.encode()).tolist() == plain.encode(text, add_special_tokens=False).ids and c.held <= 2000 + 20_000


def test_odd_rows(spark, plain):
    long = "lorem  ipsum dolor\n" * 20_000
    rows = [(1, None, 7), (2, "", 7), (2, "", 7), (None, "a  b", 7), (3, long, 7), (4, "x" * 50_000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted((r["doc_id"] or 0, r["ids"], r["decoded"]) for r in bpe.encode(df, PATH).collect())
    want = sorted((d or 0, plain.encode(t or "", add_special_tokens=False).ids, t or "") for d, t, _ in rows)
    assert got == want
    assert bpe.encode(df.limit(0), PATH).count() == 0
    back = bpe.decode(bpe.encode(df, PATH).drop("decoded"), PATH, out="again").collect()
    assert sorted(r["again"] for r in back) == sorted(t or "" for _, t, _ in rows)
