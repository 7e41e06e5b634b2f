"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A text is cut before those spaces whose eight bytes before have a hash below a threshold, so equal passages
are cut alike wherever they stand, and each distinct chunk that a worker meets is encoded once. A join is
exact if the cut lies between an ASCII letter and a space, for no pre-token holds a letter before a space. Any
other join is repaired: the text from the last such place before it to the first one after is encoded anew
and takes the place of the chunks' tokens there, so that both sides meet at places where they must agree.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from larkspur.llm.common import id_text, raw, to_batches

CACHE_BYTES = 16 << 20  # chunk text that a worker remembers
ROWS = 250  # rows of one output batch
K = np.uint64(0x9E3779B97F4A7C15)
#: Fixed value: how the vocabulary's byte-level pre-tokenizer splits a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FAR = re.compile("[^\x00-ɏ]")  # beyond these the two libraries' character tables may differ
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves,
    the others, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file, with a memory of chunks."""

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        vocab, byte = spec["model"]["vocab"], byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        order = [vocab[a + b] for a, b in merges]
        if order != sorted(order) or spec["normalizer"] is not None:
            raise ValueError("not a byte-level vocabulary whose ids follow its merges")
        self.path = path
        self.fast = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        size = max([*vocab.values(), *special.values()]) + 1
        self.token = [b""] * size
        for t, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.token[i] = t
        self.width = np.array([len(t) for t in self.token])
        self.memory: dict[bytes, np.ndarray] = {}
        self.held = 0

    @cached_property
    def whole(self) -> Tokenizer:
        t = Tokenizer.from_file(self.path)
        t.no_truncation()
        t.no_padding()
        return t

    def chunk(self, text: bytes) -> np.ndarray:
        """Ids of one chunk, from memory if it was met before."""
        ids = self.memory.get(text)
        if ids is None:
            s = text.decode("utf-8")
            if s.isascii() or not FAR.search(s):
                ids = self.fast.encode_to_numpy(s, allowed_special="all").astype(np.int32)
            else:
                ids = np.array(self.whole.encode(s, add_special_tokens=False).ids, np.int32)
            if self.held + len(text) > CACHE_BYTES:
                self.memory.clear()
                self.held = 0
            self.memory[text] = ids
            self.held += len(text)
        return ids

    def encode(self, text: bytes, one_in: int = 128) -> np.ndarray:
        """Ids of a whole text; a cut falls before about one space in `one_in`."""
        x = np.frombuffer(text, np.uint8)
        space = np.flatnonzero(x[8:] == 32) + 8 if len(x) > 8 else np.empty(0, np.int64)
        if len(space):
            before = np.lib.stride_tricks.sliding_window_view(x, 8)[space - 8].view("<u8").ravel()
            space = space[before * K >> np.uint64(40) < np.uint64((1 << 24) // one_in)]
        if not len(space):
            return self.chunk(text)
        ends = [*space.tolist(), len(x)]
        parts = [self.chunk(text[a:b]) for a, b in zip([0, *ends], ends)]
        bad = space[~LETTER[x[space - 1]]]
        return np.concatenate(self.repaired(text, x, parts, bad) if len(bad) else parts)

    def repaired(self, text: bytes, x: np.ndarray, parts: list[np.ndarray], bad: np.ndarray) -> list[np.ndarray]:
        safe = np.concatenate([[0], np.flatnonzero((x[1:] == 32) & LETTER[x[:-1]]) + 1, [len(x)]])
        lo = np.unique(safe[np.searchsorted(safe, bad, side="right") - 1])
        hi = safe[np.searchsorted(safe, lo, side="right")]
        ids = np.concatenate(parts)
        at = np.concatenate([[0], np.cumsum(self.width[ids])])  # byte place of each token
        out, done = [], 0
        for a, b, i, j in zip(lo.tolist(), hi.tolist(), np.searchsorted(at, lo).tolist(), np.searchsorted(at, hi).tolist()):
            out += [ids[done:i], self.chunk(text[a:b])]
            done = j
        return [*out, ids[done:]]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.token.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each worker and vocabulary."""
    return Codec(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) for every row: the ids of the whole text under the vocabulary
    file `path` (which executors must find there) without special tokens added, and the text that these ids
    decode to. A special token's name in a text is that token. Null and empty texts have no ids and decode to
    the empty text; null ids and repeated rows are kept; an empty table gives an empty result; other columns
    are not read."""
    ids_type = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            schema = pa.schema([b.schema.field(0), ("ids", ids_type), ("decoded", pa.string())])
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                ids = [c.encode(t) for t in raw(part.column(1))]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield from to_batches(schema, [[part.column(0), pa.ListArray.from_arrays(offsets, flat.astype(np.int32)), [c.decode(x) for x in ids]]])

    src = id_text(docs, id_col, text_col)
    return src.mapInArrow(run, f"doc_id {src.dtypes[0][1]}, ids array<int>, decoded string")


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """`rows` with the text that `ids_col` decodes to in column `out`; null ids give null."""

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        c = codec(path)
        return pa.array([None if x is None else c.decode(np.array(x, np.int64)) for x in ids.to_pylist()], pa.string())

    return rows.withColumn(out, run(ids_col))


def digests(encoded: DataFrame) -> DataFrame:
    """`encoded` with n_tokens, ids_sha256 (of decimal ids joined by commas) and decoded_sha256 added."""
    return encoded.select(
        "*", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
