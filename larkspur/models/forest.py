"""Forests of least levels, and what is known to hang together before all rows meet.

A few rows, the hubs, tell in one read which rows belong to one large component from which level on. Only the others
must meet all rows, whatever their number: a link between two rows of that component is known without working it out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from larkspur.operators.neighbors import Rough, _distances, _matrix
from larkspur.session import settle

FEW = 1 << 16  # pairs that are listed without a first choice


def levels(a: np.ndarray, b: np.ndarray, epss: np.ndarray) -> np.ndarray:
    """For all pairs the first of the ascending `epss` that is no less than their distance, or len(epss).
    Pairs near a border are decided on their differences."""
    rough = Rough(a, b)
    if all(rough.serves(e) for e in epss):
        out = np.empty((len(a), len(b)), np.int8)
        for rows, sq in rough.slabs():
            at = np.arange(rows.start, rows.stop)
            least, most = sq.min(1), float(sq.max())
            part = np.zeros(sq.shape, np.int8)
            for eps in epss:
                mid = (eps / rough.unit) ** 2
                slack = 2 * rough.off + 1e-5 * mid
                if mid - slack > most:
                    break
                some = np.flatnonzero(least <= mid + slack)
                if len(some) * 4 < len(at):
                    part += 1
                    part[some] -= rough.near(at[some], sq[some], eps)
                else:
                    part += ~rough.near(at, sq, eps)
            out[rows] = part
        return out
    d = _distances(a, b)
    out, close = np.zeros(d.shape, np.int8), np.zeros(d.shape, bool)
    for eps in epss:
        out += ~(d <= eps)  # no distance, as of a null, is beyond all
        close |= np.abs(d - eps) <= 1e-9 * eps
    i, j = np.nonzero(close)
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[i[s], j[s]] = np.searchsorted(epss, np.sqrt(((a[i[s]] - b[j[s]]) ** 2).sum(1)), "left")
    return out


def row_sums(near: np.ndarray) -> np.ndarray:
    """How many hold in each row, by adding eight at a time."""
    wide = near if near.shape[1] % 8 == 0 and near.flags.c_contiguous else np.pad(near, ((0, 0), (0, -near.shape[1] % 8)))
    words = wide.view(np.uint64)
    out = np.zeros(len(near), np.int64)
    for at in range(0, words.shape[1], 255):  # a byte holds no more
        out += np.ascontiguousarray(words[:, at: at + 255].sum(1, dtype=np.uint64)).view(np.uint8).reshape(-1, 8).sum(1, dtype=np.int64)
    return out


def neighbour_counts(x: np.ndarray, y: np.ndarray, wx: np.ndarray, wy: np.ndarray, epss: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Weights of the rows of y within each of the ascending `epss` of a row of x, and with `both` those of x for y."""
    top = len(epss)
    of_x, of_y = np.zeros((len(x), top), np.int64), np.zeros((len(y), top), np.int64) if both else None
    rough = Rough(x, y)
    more_x, more_y = np.flatnonzero(wx != 1), np.flatnonzero(wy != 1)

    def add(rows: np.ndarray, i: int, near: np.ndarray) -> None:
        of_x[rows, i] += row_sums(near)
        if len(more_y):
            of_x[rows, i] += (near[:, more_y] * (wy[more_y] - 1)).sum(1)
        if both:
            of_y[:, i] += near.sum(0, dtype=np.uint32)
            some = np.flatnonzero(np.isin(rows, more_x)) if len(more_x) else ()
            if len(some):
                of_y[:, i] += (near[some] * (wx[rows[some]] - 1)[:, None]).sum(0)

    if not all(rough.serves(e) for e in epss):
        lev = levels(x, y, epss)
        for i in range(top):
            add(np.arange(len(x)), i, lev <= i)
        return of_x, of_y
    for s, sq in rough.slabs():
        at = np.arange(s.start, s.stop)
        least, most = sq.min(1), float(sq.max())
        for i, eps in enumerate(epss):
            mid = (eps / rough.unit) ** 2
            slack = 2 * rough.off + 1e-5 * mid
            if mid - slack > most:
                add(at, i, np.ones(sq.shape, bool))
                continue
            some = np.flatnonzero(least <= mid + slack)
            if len(some) * 4 < len(at):
                if len(some):
                    add(at[some], i, rough.near(at[some], sq[some], eps))
            else:
                add(at, i, rough.near(at, sq, eps))
    return of_x, of_y


def hang(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of the edges (x, y) that join trees, from rounds in which each tree takes its first edge out; `root` is
    brought up to date."""
    taken = np.zeros(len(x), bool)
    live = np.flatnonzero(root[x] != root[y])
    while len(live):
        i, j = root[x[live]], root[y[live]]
        first = np.full(len(root), len(x))
        np.minimum.at(first, i, live)
        np.minimum.at(first, j, live)
        trees = np.flatnonzero(first < len(x))
        edge = first[trees]
        taken[edge] = True
        other = root[x[edge]] + root[y[edge]] - trees
        back = (first[other] == edge) & (trees < other)  # of two trees that take the same edge the smaller stays
        root[trees] = np.where(back, trees, other)
        while (root[root] != root).any():
            root[:] = root[root]
        live = live[root[x[live]] != root[y[live]]]
    return np.flatnonzero(taken)


def spanning(a: np.ndarray, b: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Places of the edges (a, b) of a least spanning forest."""
    order = np.argsort(level, kind="stable")
    names, at = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    return np.sort(order[hang(np.arange(len(names)), at[: len(a)], at[len(a):])])


def least_forest(
    link: np.ndarray, top: int, known: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, level) of a least spanning forest of the bipartite graph whose edges are the entries below `top`.

    Levels are gone through in order. In each, pairs inside the largest tree so far tell nothing, so only rows and
    columns outside it are looked at. `known` has the level of each row and column from which on it is known to
    hang together with the others that have one; such edges are not named again."""
    n, m = link.shape
    root, out = np.arange(n + m), []
    if not n or not m:
        return (np.empty(0, np.int64),) * 3
    least = np.concatenate([link.min(1), link.min(0)])
    since = np.concatenate(known) if known else np.full(n + m, top)

    def join(i: np.ndarray, j: np.ndarray, level: int) -> None:
        keep = hang(root, i, j + n)
        out.append((i[keep], j[keep], np.full(len(keep), level)))

    for level in range(top):
        tied = np.flatnonzero(since <= level)
        if len(tied) > 1:
            hang(root, tied[:-1], tied[1:]) if len(tied) < 3 else _tie(root, tied)
        if not (least <= level).any():
            continue
        for again in (False, True):
            open_ = (root != np.bincount(root).argmax()) & (least <= level)
            rows, cols = np.flatnonzero(open_[:n]), np.flatnonzero(open_[n:])
            met = np.flatnonzero(least[n:] <= level)
            others = np.flatnonzero(~open_[:n] & (least[:n] <= level))
            if again or len(rows) * len(met) + len(others) * len(cols) <= FEW:
                break
            # a first choice each leaves few outside the largest tree
            if len(rows):
                near = link[np.ix_(rows, met)] <= level
                some = np.flatnonzero(near.any(1))
                join(rows[some], met[near[some].argmax(1)], level)
            if len(cols):
                here = np.flatnonzero(least[:n] <= level)
                near = link[np.ix_(here, cols)] <= level
                some = np.flatnonzero(near.any(0))
                join(here[near[:, some].argmax(0)], cols[some], level)
        for r, c in ((rows, met), (others, cols)):
            for at in range(0, len(r), 256):
                i, j = np.nonzero(link[np.ix_(r[at: at + 256], c)] <= level)
                if len(i):
                    join(r[at + i], c[j], level)
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*out))  # type: ignore[return-value]


def _tie(root: np.ndarray, nodes: np.ndarray) -> None:
    """All trees of the nodes become one."""
    trees = np.unique(root[nodes])
    gone = np.zeros(len(root), bool)
    gone[trees] = True
    root[gone[root]] = trees[0]


def settled(core: DataFrame, epss: np.ndarray, many: int, block: int, limit: int) -> tuple[DataFrame, list]:
    """(id, since[]) and a row's id per min_samples: from the level `since` on a row of `core` (id, v, core[]) hangs
    together with that row, len(epss) if that is not told. Needs more than `limit` rows, else nothing is told.

    The hubs, about `limit` rows drawn by hash, are few enough to be compared in one place. Their largest component at the
    last level, its largest part at the level before and so on are what the other rows are held against."""
    top, spark = len(epss), core.sparkSession
    never = core.select("id", F.array_repeat(F.lit(top), many).alias("since"))
    size = core.count()
    if size <= limit:
        return never, [None] * many
    share = int((1 << 30) * limit / size)
    hubs = core.where((F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < share) & (F.array_min("core") < top)).select("id", "v", "core").toPandas()
    if len(hubs) < 2:
        return never, [None] * many
    ids, x, c = hubs["id"].to_numpy(), _matrix(hubs["v"]), np.stack(hubs["core"].to_numpy()).astype(np.int8)
    found: list[list] = [[] for _ in range(many)]
    for i in range(0, len(x), block):
        for j in range(i, len(x), block):
            p, q = slice(i, i + block), slice(j, j + block)
            lev = levels(x[p], x[q], epss)
            for k in range(many):
                a, b, at = least_forest(np.maximum(np.maximum(lev, c[p, k][:, None]), c[q, k][None, :]), top)
                found[k].append((a + i, b + j, at))
    since, first = np.full((len(x), many), top, np.int8), []
    for k in range(many):
        a, b, at = (np.concatenate(t) for t in zip(*found[k]))
        root, trees = np.arange(len(x)), []
        for level in range(top):
            hang(root, a[at == level], b[at == level])
            trees.append(root.copy())
        inside = np.ones(len(x), bool)
        for level in reversed(range(top)):
            inside &= c[:, k] <= level
            if not inside.any():
                break
            inside &= trees[level] == np.bincount(trees[level][inside]).argmax()
            since[inside, k] = level
        best = int(since[:, k].argmin())
        first.append(ids[best].item() if hasattr(ids[best], "item") else ids[best])
        if since[best, k] == top:
            first[-1] = None
    shared = spark.sparkContext.broadcast((x, since))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, since = shared.value
        for t in batches:
            for at in range(0, len(t), block):
                rows = t.iloc[at: at + block]
                v, own = _matrix(rows["v"]), np.stack(rows["core"].to_numpy()).astype(np.int8)
                out = np.full(own.shape, top, np.int8)
                for j in range(0, len(x), block):
                    lev = levels(v, x[j: j + block], epss)
                    for k in range(many):
                        out[:, k] = np.minimum(out[:, k], np.maximum(lev, since[j: j + block, k][None, :]).min(1))
                yield pd.DataFrame({"id": rows["id"], "since": list(np.maximum(out, own).astype(np.int32))})

    kind = core.schema["id"].dataType.simpleString()
    return settle(core.select("id", "v", "core").mapInPandas(look, f"id {kind}, since array<int>")), first
