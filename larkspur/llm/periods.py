"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run of period q is a stretch of words in which every word equals the one q words on; it qualifies with
`copies` whole periods and `least` words. Each of its words then occurs at least `copies` times in it, so a
word that is rarer than that within its segment is in no qualifying run of the segment: it goes, and cuts the
segment in two. Counts are taken again in the segments that changed, until none does. Nearly all words of
ordinary text go in the first rounds.

What survives is scanned lag by lag. A run of 4 periods q covers three aligned blocks [kq, (k+1)q) in a row,
which are equal; so lag q costs a segment of L words only L/q block hashes, and all lags cost L log L. Equal
triples are extended by direct comparison, so a clash of hashes costs time and changes nothing. A lag that is
a multiple of the smallest period gives the very stretch that the period gave, and is passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from larkspur.llm.common import id_text, raw

COPIES = 4
LEAST = 6
PIECE_BYTES = 4 << 20  # text handled at a time; a longer text is a piece of its own
LAG_CELLS = 1 << 19  # block hashes compared at a time
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

Run = tuple[int, int, int]  # first word, words, period


def split_rare(code: np.ndarray, segment: np.ndarray, copies: int = COPIES, least: int = LEAST) -> list[tuple[int, int]]:
    """[start, end) of the segments that no rare word cuts further. `code` names the words, `segment` (ascending)
    the text each word is of."""
    at = np.arange(len(code))  # words of the segments that may still change
    done: list[tuple[int, int]] = []
    while len(at):
        # segment numbers are dense, so the key is less than the square of the words
        _, key = np.unique(segment * (code.max() + 1) + code, return_inverse=True)
        keep = np.bincount(key)[key] >= copies
        kept, of = at[keep], segment[keep]
        if not len(kept):
            break
        new = np.concatenate([[True], (np.diff(kept) > 1) | (np.diff(of) > 0)])
        part = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(kept)))
        # a segment that came through whole is stable
        before = np.bincount(segment, minlength=int(segment[-1]) + 1)
        stable = size == before[of[first]]
        for i in np.flatnonzero(stable & (size >= least)).tolist():
            done.append((int(kept[first[i]]), int(kept[first[i]]) + int(size[i])))
        go = (~stable & (size >= least))[part]
        at, code = kept[go], code[keep][go]
        segment = np.unique(part[go], return_inverse=True)[1]
    return sorted(done)


def _stretch(w: np.ndarray, q: int, i: int, j: int) -> tuple[int, int]:
    """The maximal [a, b) around [i, j) with w[x] == w[x + q] for all its x, or (i, i) if [i, j) isn't such."""
    if not (w[i:j] == w[i + q: j + q]).all():
        return i, i
    step, end = 64, len(w) - q
    while j < end:
        to = min(end, j + step)
        bad = np.flatnonzero(w[j:to] != w[j + q: to + q])
        if len(bad):
            j += int(bad[0])
            break
        j, step = to, 2 * step
    step = 64
    while i > 0:
        to = max(0, i - step)
        bad = np.flatnonzero(w[to:i] != w[to + q: i + q])
        if len(bad):
            i = to + int(bad[-1]) + 1
            break
        i, step = to, 2 * step
    return i, j


def _equal_triples(w: np.ndarray, last: int) -> Iterator[tuple[int, np.ndarray]]:
    """(q, k...) for each lag q up to `last` that has any: blocks k, k + 1 and k + 2 of q words hash alike."""
    n = len(w)
    v = w.astype(np.uint64) + np.uint64(1)
    v *= np.uint64(0xC2B2AE3D27D4EB4F)
    v ^= v >> np.uint64(29)
    v *= np.uint64(0x165667B19E3779F9)
    v ^= v >> np.uint64(32)
    power = np.ones(n + 1, np.uint64)
    power[1:] = BASE
    power = np.cumprod(power, dtype=np.uint64)
    # sum of v[i] * BASE**i: a block's hash is a difference, moved to a common power where two are compared
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * power[:-1], dtype=np.uint64)])
    lo = 1
    while lo <= last:
        lags = np.arange(lo, min(last, lo + LAG_CELLS) + 1)
        cells = np.cumsum(n // lags - 1)
        lags = lags[: max(1, int(np.searchsorted(cells, LAG_CELLS)))]
        lo = int(lags[-1]) + 1
        many = n // lags - 1  # neighbouring pairs of blocks
        q = np.repeat(lags, many)
        first = np.cumsum(many) - many
        k = np.arange(len(q)) - np.repeat(first, many)
        i = k * q
        same = (total[i + q] - total[i]) * power[q] == total[i + 2 * q] - total[i + q]
        hit = np.flatnonzero(same[:-1] & same[1:] & (q[:-1] == q[1:]))
        if len(hit):
            lag, cut = np.unique(q[hit], return_index=True)
            for x, ks in zip(lag.tolist(), np.split(k[hit], cut[1:])):
                yield x, ks


def scan_lags(w: np.ndarray, copies: int = COPIES, least: int = LEAST) -> list[Run]:
    """Every qualifying run of one segment, by start, then period."""
    found: dict[int, list[tuple[int, int]]] = {}  # period to [start, end), ascending
    for q, ks in _equal_triples(w, len(w) // copies):
        for d in [d for d in _divisors(q) if d in found]:
            starts, ends = (np.array(x) for x in zip(*found[d]))
            inside = np.searchsorted(starts, ks * q, "right") - 1
            ks = ks[(inside < 0) | (ends[inside] < (ks + 3) * q)]
        done, mine = 0, []
        for k in ks.tolist():
            if (k + 2) * q <= done:
                continue
            a, done = _stretch(w, q, k * q, (k + 2) * q)
            if done - a + q >= max(least, copies * q):
                mine.append((a, done + q))
        if mine:
            found[q] = mine
    return sorted((a, b - a, q) for q, runs in found.items() for a, b in runs)


def _divisors(q: int) -> list[int]:
    """The proper divisors of q."""
    low = [d for d in range(1, int(q**0.5) + 1) if q % d == 0]
    return sorted({*low, *(q // d for d in low)} - {q})


def runs_of(texts: list[list[bytes]], copies: int = COPIES, least: int = LEAST) -> list[list[Run]]:
    """The runs of each list of words."""
    out: list[list[Run]] = [[] for _ in texts]
    size = [len(t) for t in texts]
    if not sum(size):
        return out
    code = pd.factorize(np.array([w for t in texts for w in t], dtype=object))[0].astype(np.int64)
    text = np.repeat(np.arange(len(texts)), size)
    start = np.cumsum(size) - size
    dense = np.unique(text, return_inverse=True)[1]
    for a, b in split_rare(code, dense, copies, least):
        t = int(text[a])
        out[t] += [(s + a - int(start[t]), n, q) for s, n, q in scan_lags(code[a:b], copies, least)]
    return out


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        gone[s + q] += 1
        gone[s + n] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g] if runs else words


def _pieces(rows: list[tuple[object, bytes]]) -> Iterator[list[tuple[object, bytes]]]:
    at = size = 0
    for i, (_, t) in enumerate(rows):
        if i > at and size + len(t) > PIECE_BYTES:
            yield rows[at:i]
            at, size = i, 0
        size += len(t)
    yield rows[at:]


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", copies: int = COPIES, least: int = LEAST,
    edit: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start,length,period>>, collapsed) for every row of `docs`.

    Words are the stretches without ASCII white space of the whole text; a null or empty text has none and
    gives no runs and an empty `collapsed`. A run is a stretch of words of smallest period `period` with at
    least `copies` whole periods (4 or more) and `least` words that no neighbouring word extends; runs come by start, then
    period, and may overlap. `collapsed` keeps the words that no run holds after its first period, joined by
    single blanks. `edit(id, words)`, if given, changes a row's words before. Each row is judged by itself, so
    repeated rows and ids give equal rows; null ids are kept; other columns are not read; an empty table gives
    an empty result. Nothing is shuffled; a task holds one batch of texts.
    """
    if copies < COPIES:
        raise ValueError(f"copies must be at least {COPIES}")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    src = id_text(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            ids = b.column(0).to_pylist() if edit else range(b.num_rows)
            for piece in _pieces(list(zip(ids, raw(b.column(1))))) if b.num_rows else ():
                words = [t.split() for _, t in piece]
                if edit:
                    words = [edit(i, w) for (i, _), w in zip(piece, words)]
                found = runs_of(words, copies, least)
                left = [b" ".join(collapse(w, r)) for w, r in zip(words, found)]
                shown = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(piece)), pa.array(list(map(len, words)), pa.int64()), pa.array(shown, pa.list_(run)), pa.array(left, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                at += len(piece)

    return src.mapInArrow(solve, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
