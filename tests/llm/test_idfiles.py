import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larkspur.llm import idcoder, idfiles
from larkspur.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def ids_of(t, text):
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_whole_table(spark, sf, plain):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    want, at = {}, 0
    for d, text in rows:
        x = ids_of(plain, text)
        want[d] = (at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op4_id_files"](spark, sf).collect()} == want


def test_words_agree_with_the_library(plain):
    codec, rng = idfiles.WordCodec(PATH), random.Random(4)
    letters = ["abc DEF 12 '", "éÀß ñ'LL 's\t", "x\x85\xa0\x1c y²¼ª", "日本 éİΣ a", "a!?,. b's't ", "\x00\x01~×÷ ÿŸ"]
    texts = ["".join(rng.choice(c) for _ in range(rng.randint(0, 60))) for c in letters for _ in range(150)]
    texts += ["a<|endoftext|>b", "<|startoftext|>", "<|ENDOFTEXT|>", "", "don't DON'T I'LL"]
    n, ids = codec.encode([t.encode() for t in texts])
    ends = np.cumsum(n)
    for t, a, b in zip(texts, ends - n, ends):
        assert ids[a:b].tolist() == ids_of(plain, t), t


def test_split_equals_the_pattern():
    """Kinds of characters, digits and endings after an apostrophe, as the vocabulary's pattern has them."""
    blank, letter, digit = r"\t-\r \x85\xa0", "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
    pattern = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^{blank}{letter}{digit}]+")
    rng = random.Random(1)
    some = "'''stmdrevl 1!.\x1c\xa0\x85é²a\t\n"
    for _ in range(100):
        texts = ["".join(rng.choice(some) if rng.random() < 0.8 else chr(rng.randrange(256)) for _ in range(rng.randrange(40))).lower() for _ in range(rng.randrange(30))]
        words, counts = idfiles.split([t.encode("latin-1") for t in texts])
        want = [pattern.findall(t) for t in texts]
        assert [w.decode("latin-1") for w in words.to_pylist()] == sum(want, [])
        assert counts.tolist() == [len(w) for w in want]


def test_a_word_is_looked_up_once_for_a_lot(plain):
    class Counting(idfiles.WordCodec):
        asked = 0

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    codec = Counting(PATH)
    text = "one two, " * 1000
    assert codec.encode([text.encode()] * 3)[1].tolist() == ids_of(plain, text) * 3
    assert codec.asked <= 3


def test_blocks_are_the_ones_of_before():
    """Blocks already written stay readable: the bytes of one are pinned."""
    ids = np.random.default_rng(8).zipf(1.2, 600_000) % 49408
    assert zlib.crc32(idcoder.encode_ids(ids, 49408)[1].tobytes()) == 2542251611


def test_words_are_forgotten(monkeypatch, plain):
    monkeypatch.setattr(idfiles, "WORDS", 3)
    codec = idfiles.WordCodec(PATH)
    for t in ("one two three four", "four five", "one", "six one"):
        assert codec.encode([t.encode()])[1].tolist() == ids_of(plain, t)


@pytest.mark.parametrize("n", [0, 1, 2, 255, 513, 40_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.zipf(1.3, n) % 49408, rng.integers(0, 49408, n), np.zeros(n, int), np.full(n, 49407), np.tile(rng.integers(0, 300, 50), n // 50 + 1)[:n]):
        block = idcoder.pack_block([5, None, -1], np.array([n, 0, 0]), ids, 49408)
        who, lengths, back = idcoder.unpack_block(block)
        assert (back == ids).all() and who == [5, None, -1] and lengths.tolist() == [n, 0, 0]


def test_repeats_cost_little_and_damage_is_found():
    ids = np.tile(np.random.default_rng(1).integers(0, 49408, 500), 100)
    block = idcoder.pack_block([1], np.array([len(ids)]), ids, 49408)
    assert len(block) < len(ids) / 4
    with pytest.raises(ValueError):
        idcoder.unpack_block(block[:100] + bytes([block[100] ^ 1]) + block[101:])


def test_odd_rows(spark, tmp_path, plain):
    """Null and repeated ids, null and long texts, many small blocks; order and starts hold."""
    rows = [(7, "seven words"), (None, "no id"), (3, None), (3, "three"), (3, "three"), (-2, "minus"), (9, "long text, " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", idfiles.F.lit(1)).withColumn("digest", idfiles.F.lit(1))
    for name, size in (("a", 1), ("b", 1 << 20)):
        idfiles.write_ids(df, PATH, f"{tmp_path}/{name}", block_ids=size)
        out = sorted(((r["start"], r["doc_id"], r["ids"]) for r in idfiles.read_ids(spark, f"{tmp_path}/{name}").collect()), key=lambda r: r[0])
        assert [d for _, d, _ in out] == [None, -2, 3, 3, 3, 7, 9]
        at = 0
        for start, _, ids in out:
            assert start == at
            at += len(ids)
        assert sorted(ids for _, _, ids in out) == sorted(ids_of(plain, t) for _, t in rows)
    idfiles.write_ids(df.limit(0), PATH, f"{tmp_path}/none")
    assert idfiles.read_ids(spark, f"{tmp_path}/none").count() == 0
