"""Language-model scores from a log-frequency Bloom filter, beside an exact unigram base score.

Every word and every pair of neighbouring words of the training texts is counted over the whole corpus. A
count c is kept as its level 1 + floor(log2 c), and the filter holds the entries (n-gram, 1) to (n-gram,
level); a scorer asks for level after level until one is missing. The filter is cut into one segment per range
of n-gram keys. The task that counts a range knows its entries and gives each ENTRY_BITS, so the filter grows
with the corpus and its false hits do not. No segment leaves its task: the n-grams of the texts come to it.
With mid-level counts c,

    P(w | v) = mix * min(1, c(v w) / c(v)) + (1 - mix) * (c(w) + 1) / (N + V + 1),

the second part alone where v was not seen. Counting moves packed arrays, not rows: a chunk of documents
sends each key range its distinct words and pairs with their training counts. The range's task knows the
totals and sends each chunk, in the order it asked, the totals of its words and the filter's levels of its
words and pairs; the chunk's tokens wait at home for them. Every range hears from every chunk and replies to
it, if only with its share of N and V.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.common import id_text, pack_sorted, raw, to_batches, unpack_sorted
from larkspur.llm.quality import held_out

CHUNK_DOCS = 4096
RANGE_BYTES = 16 << 20  # corpus text for each range of keys
FILTER_BYTES = 64 << 20  # bound of one range's segment
PROBES = 2
ENTRY_BITS = 12  # with 2 probes 15% of the bits are set, and 2.4% of the entries asked for are false hits
LEVELS = 48
MIX = 0.3
END = b"\n"  # no word holds white space
KEY_BITS = 42
U = np.uint64
K1, K2, K3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
WORDS, PAIRS, TOKENS, REPLY = range(4)
DDL = "range int, kind int, chunk long, data binary"
SCHEMA = pa.schema([("range", pa.int32()), ("kind", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary())])


class _Local(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct token, each token's place among them, tokens of each text); the end is a token."""
    local, flat, count = _Local(), [], []
    local[END]
    for t in texts:
        w = t.lower().split()
        w.append(END)
        flat += map(local.__getitem__, w)
        count.append(len(w))
    h = xxhash.xxh3_64_intdigest
    return np.array([h(w) for w in local], U), np.array(flat, np.int64), np.array(count, np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> U(29)) * K2
    return (x ^ x >> U(32)) * K1


def pair_keys(hashes: np.ndarray, place: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A key for (token before, token) at each token; before a text's first token stands the end."""
    before = np.empty_like(place)
    before[1:] = place[:-1]
    before[np.cumsum(count) - count] = 0  # END's place
    return _mixed(hashes[before] * K3 + hashes[place]) >> U(64 - KEY_BITS)


def word_keys(hashes: np.ndarray) -> np.ndarray:
    return _mixed(hashes) >> U(64 - KEY_BITS)


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys * U(ranges) >> U(KEY_BITS)).astype(np.int64)


def probe(keys: np.ndarray, level: int, i: int, bits: int) -> np.ndarray:
    salt = U((level * int(K1) + i * int(K3)) % (1 << 64))
    return (_mixed(keys + salt) >> U(32)) * U(bits) >> U(32)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c), exactly."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def middle(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of its range, 0 for none."""
    return np.where(level > 0, (1.5 * 2.0**level - 1) / 2, 0.0)


class Filter:
    def __init__(self, segments: bytes, n: int):
        self.n, self.bits = n, 8 * len(segments) // n
        self.bytes = np.frombuffer(segments, np.uint8)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which every entry of each key is there."""
        out = np.zeros(len(keys), np.int64)
        base = range_of(keys, self.n) * self.bits
        at = np.arange(len(keys))
        for level in range(1, LEVELS):
            for i in range(PROBES):
                place = base[at] + probe(keys[at], level, i, self.bits).astype(np.int64)
                at = at[(self.bytes[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)]
            if not len(at):
                return out
            out[at] = level
        return out


def set_bits(keys: np.ndarray, counts: np.ndarray, bits: int, into: np.ndarray) -> None:
    levels = levels_of(counts)
    for level in range(1, int(levels.max(initial=0)) + 1):
        some = keys[levels >= level]
        for i in range(PROBES):
            place = probe(some, level, i, bits).astype(np.int64)
            np.bitwise_or.at(into, place >> 3, (1 << (place & 7)).astype(np.uint8))


def segment_of(keys: np.ndarray, counts: np.ndarray, most: int) -> Filter:
    """A range's n-grams, ENTRY_BITS for each (n-gram, level)."""
    size = max(1, -(-int(levels_of(counts).sum()) * ENTRY_BITS // 8))
    if size > most:
        raise ValueError(f"a key range needs a segment of {size} bytes, filter_bytes is {most}: use a smaller range_bytes")
    out = np.zeros(size, np.uint8)
    set_bits(keys, counts, 8 * size, out)
    return Filter(out.tobytes(), 1)


def _pack(x: tuple) -> bytes:
    data = pickle.dumps(x)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpack(data: bytes) -> tuple:
    return pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True))


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as four planes of bytes, which compress better than the numbers."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _word_order(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """A chunk's words by range, then hash: the order in which they are sent and replied to."""
    return np.lexsort((hashes, range_of(word_keys(hashes), ranges)))


def _send(ranges: int):
    """Chunks of documents to packed counts by key range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for b in batches:
            for i in range(0, b.num_rows, CHUNK_DOCS):
                part = b.slice(i, CHUNK_DOCS)
                texts, out = raw(part.column(1)), part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                hashes, place, count = tokens(texts)
                train = np.repeat(~out, count)
                pairs, at = np.unique(pair_keys(hashes, place, count), return_inverse=True)
                order = _word_order(hashes, ranges)
                words = hashes[order]
                rows = [(chunk % ranges, TOKENS, _pack((part.column(0).to_pylist(), out, count, hashes, _planes(place))))]
                for kind, asked, r, seen in (
                    (WORDS, words, range_of(word_keys(words), ranges), np.bincount(place, train, len(hashes))[order]),
                    (PAIRS, pairs, range_of(pairs, ranges), np.bincount(at, train, len(pairs))),
                ):
                    ends = np.searchsorted(r, np.arange(ranges + 1))
                    for k in range(ranges) if kind == WORDS else np.flatnonzero(np.diff(ends)).tolist():
                        a, z = ends[k], ends[k + 1]
                        rows.append((k, kind, _pack((pack_sorted(asked[a:z]), _narrow(seen[a:z].astype(np.int64))))))
                yield from to_batches(SCHEMA, [[[r for r, _, _ in rows], [k for _, k, _ in rows], [chunk] * len(rows), [d for _, _, d in rows]]])
                chunk += 1

    return run


def _totals(told: list[tuple[int, tuple]]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """What chunks told as distinct n-grams, their totals, and where each chunk's own are among them."""
    asked = [unpack_sorted(x[0]) for _, x in told]
    every, at = np.unique(np.concatenate(asked or [np.empty(0, U)]), return_inverse=True)
    total = np.bincount(at, np.concatenate([x[1] for _, x in told] or [np.empty(0)]), len(every)).astype(np.int64)
    return every, total, list(zip([chunk for chunk, _ in told], np.split(at, np.cumsum([len(x) for x in asked])[:-1])))


def _count(most: int):
    """One range: totals, the filter's segment, and each chunk's reply."""

    def run(t: pa.Table) -> pa.Table:
        r = t["range"][0].as_py()
        told: dict[int, list] = {WORDS: [], PAIRS: []}
        rows = []
        for kind, chunk, data in zip(*(t[c].to_pylist() for c in ("kind", "chunk", "data"))):
            if kind == TOKENS:
                rows.append((kind, chunk, data))
            else:
                told[kind].append((chunk, _unpack(data)))
        words, total, by_word = _totals(told.pop(WORDS))
        pairs, pair_total, by_pair = _totals(told.pop(PAIRS))
        keys = np.concatenate([word_keys(words), pairs])
        counts = np.concatenate([total, pair_total])
        level = segment_of(keys[counts > 0], counts[counts > 0], most).level(keys).astype(np.uint8)
        n, v, mine_pair, none = int(total.sum()), int(np.count_nonzero(total)), dict(by_pair), np.empty(0, np.int64)
        for chunk, w in by_word:
            rows.append((REPLY, chunk, _pack((n, v, _narrow(total[w]), level[w], level[len(words) + mine_pair.get(chunk, none)]))))
        kind, chunk, data = zip(*rows)
        return pa.table([[r] * len(rows), kind, chunk, data], schema=SCHEMA)

    return run


OUT_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(ranges: int, mix: float):
    """One chunk: its tokens and the replies to its documents' scores."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(t: pa.Table) -> pa.Table:
        replies, home = [], None
        for r, kind, data in zip(*(t[c].to_pylist() for c in ("range", "kind", "data"))):
            if kind == TOKENS:
                home = _unpack(data)
            else:
                replies.append((r, _unpack(data)))
        ids, out, count, hashes, place = home
        place = _unplanes(place)
        ns, vs, *mine = zip(*(x for _, x in sorted(replies, key=lambda x: x[0])))
        n, v, (total, one, two) = sum(ns), sum(vs), map(np.concatenate, mine)
        rank = np.argsort(_word_order(hashes, ranges))
        total, one = total[rank].astype(np.int64), middle(one[rank])
        _, at = np.unique(pair_keys(hashes, place, count), return_inverse=True)
        start = np.cumsum(count) - count
        base = np.add.reduceat(np.log10(total + 1.0)[place], start) - count * np.log10(n + v + 1.0)
        known = np.add.reduceat((total > 0)[place].astype(np.int64), start)
        score = np.add.reduceat(np.log10(token_chances(place, start, one, middle(two)[at], n, v, mix)), start)
        return pa.table([ids, out, count, known, np.full(len(ids), n), base, score], schema=schema)

    return run


def token_chances(place: np.ndarray, start: np.ndarray, one: np.ndarray, two: np.ndarray, n: int, v: int, mix: float = MIX) -> np.ndarray:
    """The model's P of each token, from mid-level counts of the distinct words and of each token's pair."""
    before = np.empty_like(place)
    before[1:] = place[:-1]
    before[start] = 0  # END's place
    low = (one[place] + 1) / (n + v + 1)
    seen = one[before]
    return np.where(seen > 0, mix * np.minimum(1.0, two / np.maximum(seen, 1.0)) + (1 - mix) * low, low)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2, filter_bytes: int = FILTER_BYTES, range_bytes: int = RANGE_BYTES, mix: float = MIX) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of `docs`.

    Words are split at ASCII white space after lower-casing A-Z; each text ends in one end token; null reads
    as empty. Rows whose crc32(id as text) mod `folds` is `fold` are held out of training; null ids train.
    base_score and the counts are exact, score comes from the filter, whose size goes by its entries. A key
    range holds `range_bytes` of corpus text; one whose segment would pass `filter_bytes` raises. Repeated rows count as often as they stand and score alike. Without training texts nothing is
    known and both scores are 0. An empty table gives an empty result; other columns are not read.
    """
    src = id_text(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id"), folds, fold).alias("out"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // range_bytes))
    counted = src.mapInArrow(_send(ranges), DDL).groupBy("range").applyInArrow(_count(filter_bytes), DDL)
    return counted.groupBy("chunk").applyInArrow(_scores(ranges, mix), OUT_DDL)
