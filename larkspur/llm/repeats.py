"""Repeated byte strings across documents, by column-wise construction of a collection's suffix order.

A string of `size` bytes repeats if it starts at two places. Content decides where to look: among the first
`span_of(size)` 8-byte words of every window the one of least hash is the window's anchor, so equal windows have equal
anchors at equal offsets, and the windows of one anchor are a run of starts. Runs whose anchor string occurs
once have no repeat; runs that are equal as a whole repeat as a whole, however many copies there are. What
is left, mostly the edges of passages, is settled by the column-wise method:

all runs of one group of anchor strings are a small collection of documents, aligned at the anchor. From the
right end each round inserts one symbol of every document: the new suffixes' order is the stable order by
(group, symbol) of the column before, as in a Burrows-Wheeler transform's LF step, and the common prefix of
neighbours is one more than the least common prefix between their old places. A round keeps just its column
(order and common prefixes, two sequential arrays that the next round reads once). Windows whose common
prefix with a neighbour is at least `size` repeat.

Building whole documents column by column instead takes as many rounds as the longest document has bytes,
each a pass over the whole transform: no cluster does that at scale (see README).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm.common import bucket_of, drop_shuffles, id_text, raw, to_batches
from larkspur.session import settle

SIZE = 400
WORD = 8
PIECE = 1 << 22  # window starts handled at a time
LEAST = 64  # shorter strings would be told apart by anchors of a few bytes
RUNS = 20_000  # runs of one task's collection
HOT = 200_000  # an anchor string with more unsettled runs is settled by counting single windows
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
MARK = "g long, h long, dk binary, p int, s0 int, s1 int"


def span_of(size: int) -> int:
    """Start words among which a window's anchor is found: the largest power of two that leaves a whole word."""
    return 1 << ((size - WORD).bit_length() - 1)


def anchor_runs(x: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, s0, s1): windows that start in [s0, s1] have their anchor at p."""
    n, out, span = len(x), [], span_of(size)
    for i in range(0, n - size + 1, PIECE):
        y = x[i: i + PIECE + size - 1]
        v = np.lib.stride_tricks.sliding_window_view(y, WORD).copy().view("<u8").ravel()
        v *= K1
        v ^= v >> np.uint64(29)
        v *= K2
        v >>= np.uint64(24)
        v <<= np.uint64(24)
        v |= np.arange(len(v), dtype=np.uint64)
        step = 1
        while step < span:
            v = np.minimum(v[:-step], v[step:])
            step *= 2
        p = (v[: len(y) - size + 1] & np.uint64((1 << 24) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(p)) + 1
        s0 = np.concatenate([[0], cut])
        s1 = np.concatenate([cut, [len(p)]]) - 1
        out.append((p[s0] + i, s0 + i, s1 + i))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, np.int64),) * 3  # type: ignore[return-value]


def _marks(texts: DataFrame, size: int) -> DataFrame:
    """A row for each run of each text: g and h are hashes of the anchor string and of the run as a whole,
    dk is the text's digest."""
    schema = pa.schema([("g", pa.int64()), ("h", pa.int64()), ("dk", pa.binary()), ("p", pa.int32()), ("s0", pa.int32()), ("s1", pa.int32())])
    span = span_of(size)
    least = size - span + 1  # bytes from the anchor on that all windows of a run hold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h64 = xxhash.xxh3_64_intdigest
        for b in batches:
            for text in raw(b.column(0)):
                if len(text) < size:
                    continue
                p, s0, s1 = anchor_runs(np.frombuffer(text, np.uint8), size)
                at = list(zip(p.tolist(), s0.tolist(), s1.tolist()))
                g = np.array([h64(text[a: a + least]) for a, _, _ in at], np.uint64).view(np.int64)
                h = np.array([h64(text[b0: b1 + size], (a - b0) * span + a - b1) for a, b0, b1 in at], np.uint64).view(np.int64)
                dk = pa.array([hashlib.md5(text).digest()] * len(p), pa.binary())
                yield from to_batches(schema, [[g, h, dk, p.astype(np.int32), s0.astype(np.int32), s1.astype(np.int32)]])

    return texts.mapInArrow(run, MARK)


def columns(group: np.ndarray, p: np.ndarray, segments: list[bytes], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each offset o from the anchor: the runs that have a window starting o bytes before it, and whether
    that window equals another run's of its group. `p` is the anchor's place in its segment, `segments` the
    bytes of the run's windows."""
    n = len(segments)
    length = np.array([len(s) for s in segments])
    ahead, behind = int((length - p).max()), int(p.max())
    board = np.zeros((n, behind + ahead), np.uint8)
    for i, s in enumerate(segments):
        board[i, behind - p[i]: behind - p[i] + len(s)] = np.frombuffer(s, np.uint8)
    board = np.ascontiguousarray(board.T)
    _, group = np.unique(group, return_inverse=True)
    order = np.argsort(group, kind="stable")  # the empty suffixes: by group, nothing in common
    shared = np.zeros(n, np.int64)  # common prefix with the one before
    key = group * 257  # no symbol yet, or a byte
    last = length - p  # offset after the segment's last byte
    for o in range(ahead - 1, -behind - 1, -1):
        old = order
        known = (o < last[old]) & (o >= -p[old])
        # those without a symbol here have not begun yet (they keep their place, nothing in common) or have ended (they leave)
        stay = o >= -p[old]
        place = np.flatnonzero(stay)
        mine = old[place]
        live = known[place]
        k = key[mine] + np.where(live, board[behind + o][mine] + np.int64(1), 0)
        move = np.argsort(k, kind="stable")
        order, at, k, live = mine[move], place[move], k[move], live[move]
        new = np.zeros(len(order), np.int64)
        same = np.flatnonzero((k[1:] == k[:-1]) & live[1:] & live[:-1])
        if len(same):
            bounds = np.empty(2 * len(same), np.int64)
            bounds[::2], bounds[1::2] = at[same] + 1, at[same + 1] + 1
            new[same + 1] = np.minimum.reduceat(np.append(shared, 0), bounds)[::2] + 1
        shared = new
        if o <= 0:
            starts = last[order] - o >= size
            near = shared >= size
            twin = near.copy()
            twin[:-1] |= near[1:]
            yield -o, order[starts], twin[starts]

def spans_of(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending window starts as maximal runs [start, end of the last window)."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate([[0], cut + 1])], starts[np.append(cut, len(starts) - 1)] + size


def _settle_runs(fine: DataFrame, size: int, runs: int) -> DataFrame:
    """(dk, start, end): repeated windows of the runs marked `ask`."""
    schema = pa.schema([("dk", pa.binary()), ("start", pa.int32()), ("end", pa.int32())])

    def solve(t: pa.Table) -> pa.Table:
        g, s0, s1, p = (t[c].to_numpy() for c in ("g", "s0", "s1", "p"))
        dk, ask = t["dk"].to_pylist(), t["ask"].to_numpy()
        found = np.zeros((len(g), span_of(size)), bool)  # by offset before the anchor
        for o, who, twin in columns(g, p - s0, t["bytes"].to_pylist(), size):
            found[who[twin & ask[who] & (p[who] - o <= s1[who])], o] = True
        out: list[list] = [[], [], []]
        for i in np.flatnonzero(found.any(axis=1)).tolist():
            a, b = spans_of(np.sort(p[i] - np.flatnonzero(found[i])), size)
            out[0] += [dk[i]] * len(a)
            out[1] += a.tolist()
            out[2] += b.tolist()
        return pa.table(out, schema=schema)

    n = max(1, -(-fine.count() // runs))
    return fine.groupBy(bucket_of(F.col("g"), n).alias("part")).applyInArrow(solve, "dk binary, start int, end int")


def _single_windows(hot: DataFrame, size: int) -> DataFrame:
    """The same for runs of hot anchor strings: windows meet one by one, counted before the shuffle."""
    schema = pa.schema([("w", pa.binary()), ("dk", pa.binary()), ("start", pa.int32()), ("ask", pa.bool_())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.select(["dk", "s0", "s1", "ask", "bytes"]).to_pylist():
                k = r["s1"] - r["s0"] + 1
                w = [xxhash.xxh3_128_digest(r["bytes"][i: i + size]) for i in range(k)]
                yield from to_batches(schema, [[w, [r["dk"]] * k, list(range(r["s0"], r["s1"] + 1)), [r["ask"]] * k]])

    w = hot.mapInArrow(cut, "w binary, dk binary, start int, ask boolean")
    twice = w.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    return w.where("ask").join(twice, "w").select("dk", "start", (F.col("start") + size).alias("end"))


def repeated_spans(docs: DataFrame, size: int = SIZE, text_col: str = "text", runs: int = RUNS, hot: int = HOT) -> DataFrame:
    """(dk, spans): for each text (by MD5 digest) that holds repeated windows, their ranges [start, end)."""
    if size < LEAST:
        raise ValueError(f"size must be at least {LEAST}")
    texts = docs.select(docs[text_col].cast("string").alias("text"))
    marks = _marks(texts, size)
    shared = settle(marks.groupBy("g").agg(F.count("*").alias("n"), (F.min("h") == F.max("h")).alias("whole")).where("n > 1"))
    kept = settle(marks.join(shared.select("g", "whole"), "g"))
    drop_shuffles(docs.sparkSession)
    mixed = kept.where("not whole")
    same = mixed.groupBy("g", "h").agg(F.count("*").alias("n"), F.min(F.struct("dk", "p", "s0", "s1")).alias("one"))
    fine = same.select("g", (F.col("n") == 1).alias("ask"), "one.*")
    many = fine.groupBy("g").agg(F.count("*").alias("many"))
    fine = fine.join(many, "g").withColumn("many", F.col("many") > hot)
    wanted = fine.groupBy("dk").agg(F.collect_list(F.struct("g", "ask", "p", "s0", "s1", "many")).alias("runs"))

    cut = pa.schema([("g", pa.int64()), ("ask", pa.bool_()), ("dk", pa.binary()), ("p", pa.int32()), ("s0", pa.int32()), ("s1", pa.int32()), ("many", pa.bool_()), ("bytes", pa.binary())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dk, text, rows in zip(b.column(0).to_pylist(), raw(b.column(1)), b.column(2).to_pylist()):
                k = [[r[c] for r in rows] for c in ("g", "ask", "p", "s0", "s1", "many")]
                yield from to_batches(cut, [[k[0], k[1], [dk] * len(rows), k[2], k[3], k[4], k[5], [text[r["s0"]: r["s1"] + size] for r in rows]]])

    by_digest = texts.where(F.octet_length("text") >= size).select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("dk"), "text")
    by_digest = by_digest.groupBy("dk").agg(F.any_value("text").alias("text"))  # copies would cut the same runs again
    segments = settle(by_digest.join(wanted, "dk").select("dk", "text", "runs").mapInArrow(take, "g long, ask boolean, dk binary, p int, s0 int, s1 int, many boolean, bytes binary"))
    drop_shuffles(docs.sparkSession)
    windows = _settle_runs(segments.where("not many"), size, runs).union(_single_windows(segments.where("many"), size))
    # a text's runs repeat as a whole but for those that stand alone in a mixed group: these are taken off again
    # where the text's rows meet, so that no join gives each copy of a hot run its count
    rows = kept.select("dk", F.col("s0").alias("start"), (F.col("s1") + size).alias("end"), F.lit("run").alias("kind"))
    rows = rows.union(fine.where("ask").select("dk", "s0", F.col("s1") + size, F.lit("alone"))).union(windows.select("*", F.lit("window")))
    # one number for each range: set operations on arrays of structs compare all with all
    code = F.shiftleft(F.col("start").cast("long"), 32) + F.col("end")
    of = lambda kind: F.collect_set(F.when(F.col("kind") == kind, code))
    sets = rows.groupBy("dk").agg(of("run").alias("a"), of("alone").alias("b"), of("window").alias("c"))
    codes = sets.select("dk", F.array_union(F.array_except("a", "b"), "c").alias("codes")).where(F.size("codes") > 0)
    span = lambda x: F.struct(F.shiftright(x, 32).cast("int").alias("start"), x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("end"))
    return codes.select("dk", F.transform("codes", span).alias("spans"))


def with_kept(docs: DataFrame, size: int = SIZE, text_col: str = "text", runs: int = RUNS, hot: int = HOT) -> DataFrame:
    """(row struct of all columns of `docs`, kept binary, spans): see `remove_repeats`."""
    found = repeated_spans(docs, size, text_col, runs, hot)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    both = pa.struct([("kept", pa.binary()), ("spans", span)])

    @F.arrow_udf("struct<kept:binary,spans:array<struct<start:int,end:int>>>")
    def strip(texts: pa.Array, found: pa.Array) -> pa.Array:
        kept, gone = [], []
        for text, some in zip(raw(texts), found.to_pylist()):
            merged: list[dict[str, int]] = []
            for s in sorted(some or [], key=lambda s: s["start"]):
                if merged and s["start"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                else:
                    merged.append(dict(s))
            ends = [0, *(s["end"] for s in merged)]
            kept.append(b"".join(text[a: s["start"]] for a, s in zip(ends, merged)) + text[ends[-1]:])
            gone.append(merged)
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(gone, span)], fields=list(both))

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].cast("string").alias("text"))
    keyed = rows.withColumn("dk", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    return keyed.join(found, "dk", "left").select("row", strip("text", "spans").alias("out")).select("row", "out.*")


def readable(kept: Column) -> Column:
    """Kept bytes as text; what is left of a character that was cut in two goes too."""

    @F.arrow_udf("string")
    def run(kept: pa.Array) -> pa.Array:
        return pa.array([x.decode("utf-8", "ignore") for x in kept.to_pylist()], pa.string())

    return run(kept)


def remove_repeats(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS, hot: int = HOT) -> DataFrame:
    """(doc_id, kept binary, spans array<struct<start,end>>) for every row of `docs`.

    Texts are UTF-8 bytes; null reads as empty. Every byte inside a string of `size` bytes that also starts
    anywhere else, in another row or the same, goes; strings are judged on the input and may overlap. Equal
    texts and repeated rows are repeats of one another. `spans` are the maximal removed ranges in input bytes.
    Null ids are kept; an empty table gives an empty result; other columns are not read.
    """
    src = id_text(docs, id_col, text_col)
    return with_kept(src, size, "text", runs, hot).select("row.doc_id", "kept", "spans")
