"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a common variant at most r bits from each. So every
distinct fingerprint makes all variants within r bits, variants meet by shuffle, and those that meet link
their fingerprints. Two sources of one variant differ in at most 2r bits, so a star round the smallest
source of each variant joins all that the pairs would, without the pairs.

A fingerprint has 2,081 variants at r = 2; as plain rows they would outweigh the corpus. They travel as
sorted keys, packed by differences, about two bytes each: chunks of fingerprints send one packed run to each
range of keys, ranges send back the keys that occur twice, and chunks make those few variants again in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.common import bucket_of, id_text, pack_sorted, raw, smallest_roots, to_batches, unpack_sorted
from larkspur.models.cluster import components
from larkspur.session import settle

CHUNK = 4096  # fingerprints whose variants go out together
KEYS = 2_000_000  # variants of one range of keys
HELD = 1 << 20  # variants that a worker holds at once, about
MIX = np.uint64(0x9E3779B97F4A7C15)
SEED = 42
SLICE = 65536  # shingles whose bits are counted at a time


def fingerprint(text: bytes, words: int) -> int:
    """The fingerprint's 64 bits as a signed number; no words: 0."""
    w = text.lower().split()
    if not w:
        return 0
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        hashes = np.array([h(b" ".join(w), SEED)], np.uint64)
    else:
        joined = b" ".join(w)
        ends = (np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1).tolist()
        starts = [0, *(e + 1 for e in ends[:-1])]
        hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:])], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SLICE):
        part = np.unpackbits(hashes[i: i + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) for every row; no shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return to_batches(schema, ([b.column(0), [fingerprint(t, words) for t in raw(b.column(1))]] for b in batches))

    src = id_text(docs, id_col, text_col)
    return src.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def ball(radius: int) -> np.ndarray:
    """All 64-bit masks of at most `radius` ones."""
    bits = [1 << i for i in range(64)]
    return np.array([sum(c) for k in range(radius + 1) for c in combinations(bits, k)], np.uint64)


def runs_by_range(fps: np.ndarray, masks: np.ndarray, shift: np.uint64, borders: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(range, ascending keys) of all variants of `fps`. The variants are made anew for every few ranges, as all of them
    at once would be most of a worker's memory."""
    ranges = len(borders)
    step = max(1, ranges * HELD // max(1, len(fps) * len(masks)))
    for r in range(0, ranges, step):
        some = []
        for i in range(0, len(fps), 128):
            keys = fps[i: i + 128, None] ^ masks
            keys *= MIX
            keys >>= shift
            inside = keys >= borders[r]
            if r + step < ranges:
                inside &= keys < borders[r + step]
            some.append(keys[inside])
        keys = np.concatenate(some)
        del some
        keys.sort()
        at = [*np.searchsorted(keys, borders[r: r + step]).tolist(), len(keys)]
        yield from ((r + i, keys[a:b]) for i, (a, b) in enumerate(zip(at, at[1:])) if b > a)


def links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp`, whose components are those of all pairs at `max_bits`
    bits or fewer. At most one link per fingerprint and range of keys comes back, never all pairs of a group."""
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even: both sides flip half of it")
    spark, masks = prints.sparkSession, ball(max_bits // 2)
    n = prints.count()
    if n == 0 or max_bits == 0:
        return spark.createDataFrame([], "a long, b long")
    bits = min(64, math.ceil(math.log2(n * len(masks))) + 7)
    shift = np.uint64(64 - bits)
    ranges = -(-n * len(masks) // KEYS)
    borders = np.array([(b << bits) // ranges for b in range(ranges)], np.uint64)
    lots = -(-n // CHUNK)
    chunks = prints.withColumn("chunk", bucket_of(F.col("fp"), lots)).repartition(lots, "chunk")  # small rows, long work: a task for each
    chunks = settle(chunks.groupBy("chunk").agg(F.collect_list("fp").alias("fps")))

    packed = pa.schema([("chunk", pa.int32()), ("range", pa.int32()), ("keys", pa.binary())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, fps in zip(b.column(0).to_pylist(), b.column(1)):
                fps = fps.values.to_numpy().view(np.uint64)
                for i in range(0, len(fps), CHUNK):
                    for r, keys in runs_by_range(fps[i: i + CHUNK], masks, shift, borders):
                        yield from to_batches(packed, [[[chunk], [r], [pack_sorted(keys)]]])

    back = pa.schema([("chunk", pa.int32()), ("keys", pa.binary())])

    def meet(t: pa.Table) -> pa.Table:
        runs = [unpack_sorted(x) for x in t["keys"].to_pylist()]
        keys = np.concatenate(runs)
        keys.sort()
        twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
        out: list[list] = [[], []]
        for chunk, run in zip(t["chunk"].to_pylist(), runs):
            at = np.searchsorted(run, twice)
            mine = twice[run[np.minimum(at, len(run) - 1)] == twice]
            if len(mine):
                out[0].append(chunk)
                out[1].append(pack_sorted(mine))
        return pa.table(out, schema=back)

    sent = chunks.mapInArrow(spread, "chunk int, range int, keys binary")
    met = sent.groupBy("range").applyInArrow(meet, "chunk int, keys binary")
    asked = chunks.join(met.groupBy("chunk").agg(F.collect_list("keys").alias("keys")), "chunk").select("fps", "keys")

    whole = pa.schema([("range", pa.int32()), ("v", pa.binary()), ("fp", pa.binary())])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.uint64((1 << 22) - 1)
        for b in batches:
            for fps, blobs in zip(b.column(0), b.column(1).to_pylist()):
                fps = fps.values.to_numpy().view(np.uint64)
                want = np.unique(np.concatenate([unpack_sorted(x) for x in blobs]))
                seen = np.zeros(1 << 22, bool)
                seen[want & low] = True
                for i in range(0, len(fps), 512):
                    v = (fps[i: i + 512, None] ^ masks).ravel()
                    key = v * MIX >> shift
                    at = np.flatnonzero(seen[key & low])
                    k = key[at]
                    at = at[want[np.minimum(np.searchsorted(want, k), len(want) - 1)] == k]
                    if len(at):
                        at = at[np.argsort(key[at], kind="stable")]
                        r = np.searchsorted(borders, key[at], side="right") - 1
                        cut = [*np.flatnonzero(np.diff(r, prepend=-1)).tolist(), len(at)]
                        src = fps[i + at // len(masks)]
                        yield from to_batches(whole, [[[int(r[a]) for a in cut[:-1]], [v[at[a:c]].tobytes() for a, c in zip(cut, cut[1:])], [src[a:c].tobytes() for a, c in zip(cut, cut[1:])]]])

    pair = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def star(t: pa.Table) -> pa.Table:
        v, fp = (np.frombuffer(b"".join(t[c].to_pylist()), np.uint64) for c in ("v", "fp"))
        order = np.lexsort((fp, v))
        v, fp = v[order], fp[order]
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        centre = np.repeat(fp[first], np.diff(np.append(first, len(v))))
        near = (centre != fp) & (np.bitwise_count(centre ^ fp) <= max_bits)
        a, b = smallest_roots(centre[near].view(np.int64), fp[near].view(np.int64))
        return pa.table([a, b], schema=pair)

    return asked.mapInArrow(again, "range int, v binary, fp binary").groupBy("range").applyInArrow(star, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Words are split at ASCII white space after lower-casing A-Z; a text of fewer than `words` words is one
    shingle; null, empty and blank texts have fingerprint zero and are linked like any other. Equal texts
    and repeated rows share a fingerprint, so they cost one. component_id is the smallest doc_id that links
    reach; null ids are kept and take the smallest id beside them, or null if there is none. An empty table
    gives an empty result. Other columns are not read.
    """
    prints = settle(fingerprints(docs, words, id_col, text_col))
    reps = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = components(links(reps.select("fp"), max_bits))
    named = settle(reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    best = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_print = named.join(best, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
