"""Token ids of a corpus in files: written in document order in blocks of a context-mixing range coder
(`idcoder`), and read back.

A word vocabulary drops white space and case and splits a text into words before it merges, so each distinct
word is merged once per worker and the rest is array work. The words' merges come from the tokenizers
library's own model; a text with characters beyond Latin-1 or with a special token's opening goes through the
library whole, as its normalisation there is the library's business.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from larkspur.llm.bpe import byte_of_char
from larkspur.llm.common import id_text, raw, to_batches
from larkspur.llm.idcoder import pack_block, unpack_block

BLOCK_IDS = 1 << 21  # ids after which a block is closed, at the next document's end
WORDS = 1_000_000  # distinct words that a worker remembers
LOT = 1 << 22  # bytes of the texts whose words are looked up together
END = 1
PARTS = 1024  # partitions of one running sum
_SPACE = r"\t-\r \x85\xa0"
_LETTER = "a-zªµºß-öø-ÿ"
_DIGIT = "0-9²³¹¼½¾"
#: How the vocabulary splits a lower-case text, for Latin-1. Kinds of characters, and what may follow an
#: apostrophe: one letter, or two of which the second is named by the first.
SPACE, LETTER, DIGIT, OTHER = range(4)
KIND = bytes(next((k for k, c in ((SPACE, _SPACE), (LETTER, _LETTER), (DIGIT, _DIGIT)) if re.match(f"[{c}]", chr(i))), OTHER) for i in range(256))
SHORT = np.isin(np.arange(256), list(b"stmd"))
LONG = np.zeros(256, np.uint8)
LONG[list(b"rvl")] = list(b"eel")


class WordCodec(dict):
    """Maps each word to its place in a table of encoded words; a word not met before is encoded then."""

    def __init__(self, path: str):
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        self.opening = re.compile(b"|".join(re.escape(t.content.encode()) for t in self.whole.get_added_tokens_decoder().values()))
        self.shown = {b: c for c, b in byte_of_char().items()}
        self.size = self.whole.get_vocab_size()
        self.flat, self.begin = array("H"), array("q", [0])

    def __missing__(self, word: bytes) -> int:
        text = word.decode("latin-1")
        shown = text if word.isascii() and text.isprintable() else "".join([self.shown[b] for b in text.encode()])
        self.flat.extend([t.id for t in self.model.tokenize(shown)])
        at = self[word] = len(self.begin) - 1
        self.begin.append(len(self.flat))
        return at

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, the ids one after the other), the end id after each text."""
        if len(self) > WORDS or len(self.flat) > 8 * WORDS:
            self.clear()
            self.flat, self.begin = array("H"), array("q", [0])
        plain, odd = [], {}
        for i, text in enumerate(texts):
            low = None if self.opening.search(text) else lower(text)
            if low is None:
                odd[i] = np.array([*self.whole.encode(text.decode("utf-8"), add_special_tokens=False).ids, END], np.uint16)
            plain.append(low or b"")
        words, counts = split(plain)
        coded = words.dictionary_encode()
        place = np.fromiter(map(self.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        at = coded.indices.to_numpy()
        flat, begin = np.frombuffer(self.flat, np.uint16), np.frombuffer(self.begin, np.int64)
        first, many = begin[place][at], (begin[place + 1] - begin[place])[at]
        ends = np.cumsum(many)
        ids = flat[np.repeat(first - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)]
        total = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        out, lengths = [], np.diff(total) + 1
        end = np.array([END], np.uint16)
        if not odd:
            return lengths, np.insert(ids, total[1:], END)
        for i in range(len(texts)):
            out += [odd[i]] if i in odd else [ids[total[i]: total[i + 1]], end]
            lengths[i] = len(odd[i]) if i in odd else lengths[i]
        return lengths, np.concatenate(out)


def lower(text: bytes) -> bytes | None:
    """A UTF-8 text in lower-case Latin-1; none if it has characters beyond."""
    if text.isascii():
        return text.lower()
    s = text.decode("utf-8")
    try:
        s.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return s.lower().encode("latin-1")


def split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """(the words of all lower-case Latin-1 texts one after the other, how many each text has).

    A word starts where the kind of character changes, and each digit is one; an apostrophe that starts a word takes
    the ending after it along.
    """
    joined = b" ".join([*texts, b"  "])  # three blanks at the end
    data, kind = np.frombuffer(joined, np.uint8), np.frombuffer(joined.translate(KIND), np.uint8)
    before = np.concatenate([[SPACE], kind[:-1]])
    starts = (kind != before) & (kind != SPACE) | (kind == DIGIT)
    quote = np.flatnonzero((data == ord("'")) & (before != OTHER))
    one, two = data[quote + 1], data[quote + 2]
    for at, n in ((quote[SHORT[one]], 2), (quote[(LONG[one] == two) & (two > 0)], 3)):
        starts[at + 1] = False
        starts[at + n] = kind[at + n] != SPACE
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    counts = np.diff(np.searchsorted(np.flatnonzero(starts), ends), prepend=0)
    solid = kind != SPACE
    offsets = np.append(np.flatnonzero(starts[solid]), np.count_nonzero(solid)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])]), counts


@lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


def write_ids(docs: DataFrame, tokenizer: str, out: str, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every text, end each document with id 1 and write the ids to `out` in ascending id order.

    Documents are range-partitioned by id (equal ids by text digest), so partition by partition, block by
    block the files hold the corpus in order; a block holds whole documents. Spark's own commit writes the
    blocks, so a lost executor leaves no half file. Null ids come first, null texts are empty documents.
    """
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part, seq = word_codec(tokenizer), TaskContext.get().partitionId(), 0
        who: list = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def block() -> Iterator[pa.RecordBatch]:
            packed = pack_block(who, np.concatenate(lengths), np.concatenate(ids), codec.size)
            return to_batches(schema, [[[part], [seq], [held], [packed]]])

        for b in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = [0, *(np.flatnonzero(np.diff(size // LOT)) + 1).tolist(), b.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                some = b.slice(i, j - i)
                n, x = codec.encode(raw(some.column(1)))
                who += some.column(0).to_pylist()
                lengths.append(n)
                ids.append(x)
                held += len(x)
                if held >= block_ids:
                    yield from block()
                    seq, held = seq + 1, 0
                    who, lengths, ids = [], [], []
        if who:
            yield from block()

    src = id_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = src.withColumn("digest", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest", "text").select("doc_id", "text")
    ordered.mapInArrow(run, "part int, seq int, n_ids long, block binary").write.parquet(out)


def _starts(blocks: DataFrame) -> DataFrame:
    """(part, seq, before): ids in all blocks before each. Running sums of bounded length: blocks in their
    partition, partitions in groups of PARTS, groups."""
    named = blocks.select("part", "seq", "n_ids", F.floor(F.col("part") / PARTS).alias("grp"))
    so_far = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = named.groupBy("grp", "part").agg(F.sum("n_ids").alias("n"))
    groups = parts.groupBy("grp").agg(F.sum("n").alias("n"))
    groups = groups.select("grp", so_far(Window.orderBy("grp")).alias("g"))
    parts = parts.select("grp", "part", so_far(Window.partitionBy("grp").orderBy("part")).alias("p")).join(groups, "grp")
    own = named.withColumnRenamed("n_ids", "n").select("part", "seq", so_far(Window.partitionBy("part").orderBy("seq")).alias("s"))
    return own.join(parts, "part").select("part", "seq", (F.col("g") + F.col("p") + F.col("s")).cast("long").alias("before"))


def _read(spark: SparkSession, path: str, fields: list, ddl: str, each) -> DataFrame:
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("within", pa.int64()), ("doc_id", pa.int64()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                who, lengths, ids = unpack_block(block)
                ends = np.cumsum(lengths)
                n = len(who)
                yield from to_batches(schema, [[[part] * n, [seq] * n, ends - lengths, who, *each(lengths, ends, ids)]])

    blocks = spark.read.parquet(path)
    rows = blocks.select("part", "seq", "block").mapInArrow(run, f"part int, seq int, within long, doc_id long, {ddl}")
    return rows.join(_starts(blocks), ["part", "seq"]).withColumn("start", F.col("before") + F.col("within")).drop("part", "seq", "within", "before")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids array<int>, start long) of every document in the files; a damaged block fails the read."""

    def each(lengths, ends, ids):
        return [pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32))]

    return _read(spark, path, [("ids", pa.list_(pa.int32()))], "ids array<int>", each)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, start): as `read_ids`, with the ids' CRC-32 (little-endian, four bytes
    each) in their place, so that they needn't leave the worker."""

    def each(lengths, ends, ids):
        x = ids.astype("<u4").tobytes()
        return [lengths, [zlib.crc32(x[4 * (e - n): 4 * e]) for n, e in zip(lengths.tolist(), ends.tolist())]]

    return _read(spark, path, [("n_tokens", pa.int64()), ("ids_crc32", pa.int64())], "n_tokens long, ids_crc32 long", each)
