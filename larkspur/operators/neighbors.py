"""Exact nearest neighbours and neighbours within a radius, by cells around pivots.

Rows go to the cell of their nearest pivot. Distances to the pivots bound the distance to everything in
a cell, so a row visits only the cells that can hold an answer. Cells that lie near each other form zones of
bounded size, and a row is sent once to a zone, with a bit for each of its cells that it visits, however many
these are. Zones and their visitors are cut into blocks; a task compares one block with one block in numpy, cell by
cell and piece by piece, and sends on only its result (top k, counts, or joining edges), never the pairs. Hot cells
just have more blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.session import settle

MAX_PIVOTS = 1024
BLOCK = 2048  # rows of a piece that is compared at once
ZONE = 8  # pieces of a block that is sent to a task
SLICE = 1 << 21  # bounds worked out at once
SLAB = 256  # rows whose distances to a piece are worked out at once


@dataclass
class Cells:
    pivots: np.ndarray  # at most MAX_PIVOTS rows
    size: np.ndarray
    radius: np.ndarray
    closest: np.ndarray  # per cell the k smallest distances to the pivot, padded with inf

    def zones(self, block: int) -> list[np.ndarray]:
        """The cells in use as groups of neighbours of at most `block` rows, or a single cell of more."""
        used = np.flatnonzero(self.size > 0)
        spans = self.pivots[used]
        if not len(used):
            return []

        def cut(cells: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
            if len(cells) == 1 or self.size[cells].sum() <= block:
                return [cells]
            order = np.argsort(at[:, np.ptp(at, axis=0).argmax()], kind="stable")
            total = self.size[cells[order]].cumsum()
            half = int(np.clip(np.searchsorted(total, total[-1] / 2) + 1, 1, len(cells) - 1))
            return cut(cells[order[:half]], at[order[:half]]) + cut(cells[order[half:]], at[order[half:]])

        return cut(used, spans)

    def holding(self, placed: DataFrame) -> Cells:
        """The same cells for some of their rows only."""
        size = np.zeros(len(self.size))
        for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect():  # a row per cell
            size[r["cell"]] = r["n"]
        return replace(self, size=size) if size.any() else self


def _vec(df: DataFrame, feats: str | list) -> Column:
    if not isinstance(feats, str):
        return F.array(*[F.col(c).cast("double") for c in feats])
    if df.schema[feats].dataType.typeName() == "vectorudt":
        return vector_to_array(feats)
    return F.col(feats).cast("array<double>")


def points(df: DataFrame, key: str, feats: str | list) -> DataFrame:
    """(id, v) with the feature columns as one array."""
    return df.select(F.col(key).alias("id"), _vec(df, feats).alias("v"))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, to a relative error of 1e-10: by differences in few dimensions, else by products around
    a shared centre, where the pairs that lose digits that way are worked out by differences."""
    if a.shape[1] <= 4:
        return np.sqrt(sum(np.subtract.outer(a[:, j], b[:, j]) ** 2 for j in range(a.shape[1])))
    centre = b.mean(0)
    x, y = a - centre, b - centre
    norms = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :]
    sq = norms - 2.0 * (x @ y.T)
    lost = sq < 1e-3 * norms + 1e-20 * (centre @ centre)
    for i in np.flatnonzero(lost.any(1)):
        j = np.flatnonzero(lost[i])
        sq[i, j] = ((a[i] - b[j]) ** 2).sum(1)
    return np.sqrt(sq)


class Rough:
    """Squared distances of the rows of a and b in single precision, around a shared centre and in a unit in which none
    runs out of range. No one is off by more than `off`, by the bound on the error of a sum of products. `sound` is
    False where that does not serve: in few dimensions and for values that aren't finite."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        with np.errstate(all="ignore"):
            centre = b.mean(0)
            x, y = a - centre, b - centre
            self.unit = float(max(np.abs(x).max(), np.abs(y).max()))
        self.a, self.b = a, b
        self.sound = a.shape[1] > 4 and 1e-100 < self.unit < 1e100
        if self.sound:
            x, y = x / self.unit, y / self.unit
            nx, ny = (x * x).sum(1), (y * y).sum(1)
            self.off = float((a.shape[1] + 18) * 2.0**-23 * (nx.max() + ny.max()) + 1e-30)
            self.left = np.column_stack([-2 * x, nx, np.ones(len(x))]).astype(np.float32)
            self.right = np.ascontiguousarray(np.column_stack([y, np.ones(len(y)), ny]).T, dtype=np.float32)

    def serves(self, eps: float) -> bool:
        """Whether few distances are too near to eps to be told from it."""
        return self.sound and self.off <= 0.05 * (eps / self.unit) ** 2 < 1e30

    def slabs(self) -> Iterator[tuple[slice, np.ndarray]]:
        """(rows, squared distances in units) of a few rows of a at a time, as many as stay in a core's cache."""
        for at in range(0, len(self.left), SLAB):
            rows = slice(at, min(at + SLAB, len(self.left)))
            yield rows, self.left[rows] @ self.right

    def near(self, rows: np.ndarray, sq: np.ndarray, eps: float) -> np.ndarray:
        """Which of the pairs of `rows` of a with all of b are at most eps apart, exactly: those whose `sq` does not tell
        are decided on their differences."""
        mid = (eps / self.unit) ** 2
        slack = self.off + 1e-6 * mid
        out = sq <= np.float32(mid + slack)
        sure = sq <= np.float32(mid - slack)
        if np.count_nonzero(out) != np.count_nonzero(sure):
            np.logical_xor(out, sure, out=sure)
            some = np.flatnonzero(sure.any(1))
            i, j = np.nonzero(sure[some])
            i = some[i]
            for at in range(0, len(i), 1 << 16):
                s = slice(at, at + (1 << 16))
                out[i[s], j[s]] = np.sqrt(((self.a[rows[i[s]]] - self.b[j[s]]) ** 2).sum(1)) <= eps
        return out


def within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Which pairs are at most `eps` apart; those near the border are decided on their differences."""
    rough = Rough(a, b) if len(a) and len(b) else None
    if rough and rough.serves(eps):
        near = np.empty((len(a), len(b)), bool)
        for rows, sq in rough.slabs():
            near[rows] = rough.near(np.arange(rows.start, rows.stop), sq, eps)
        return near
    d = _distances(a, b)
    near = d <= eps
    i, j = np.nonzero(np.abs(d - eps) <= 1e-9 * eps)
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        near[i[s], j[s]] = np.sqrt(((a[i[s]] - b[j[s]]) ** 2).sum(1)) <= eps
    return near


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float64)


def _choose_pivots(pts: DataFrame, n: int) -> np.ndarray:
    count = int(max(1, min(MAX_PIVOTS, round(n**0.5 / 2))))
    rows = pts.orderBy(F.xxhash64("v"), F.xxhash64("id")).limit(count).collect()
    return np.unique(np.array([r["v"] for r in rows], dtype=np.float64), axis=0)


def build_cells(pts: DataFrame, k: int) -> tuple[DataFrame, Cells]:
    """Points (with any further columns) with cell and distance to its pivot, and the bounds per cell."""
    pivots = _choose_pivots(pts, pts.count())
    shared = pts.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                d = _distances(_matrix(b["v"]), shared.value)
                c = d.argmin(1)
                yield b.assign(cell=c.astype("int32"), dist=d[np.arange(len(b)), c])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pts.schema.fields)
    placed = settle(pts.mapInPandas(assign, f"{columns}, cell int, dist double"))
    m = len(pivots)
    size, radius = np.zeros(m), np.zeros(m)
    closest = np.full((m, max(k, 1)), np.inf)
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("dist"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("r")).collect()
    for r in sizes:
        size[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    if k:
        # at most k rows per cell, cut before the shuffle
        for r in placed.select("cell", "dist", rank.alias("rk")).where(F.col("rk") <= k).select("cell", "dist", "rk").collect():
            closest[r["cell"], r["rk"] - 1] = r["dist"]
    return placed, Cells(pivots, size, radius, closest)


def _near(pts: pd.DataFrame, cells: Cells, between: np.ndarray, reach) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, near): slices of the rows, and which cells may hold something within reach of them."""
    step = max(1, SLICE // max(1, cells.closest.size))
    slack = 1e-9 + 1e-12 * np.abs(cells.pivots).max()
    for at in range(0, len(pts), step):
        part = pts.iloc[at: at + step]
        d = _distances(_matrix(part["v"]), cells.pivots)
        limit = reach(d, part)
        limit = (limit[:, None] if limit.ndim == 1 else limit) * (1 + 1e-9) + slack
        # farther pivot's half-space: how deep the cell border lies at least
        gap = between[d.argmin(1)]
        depth = d**2 * (1 - 1e-9) - d.min(1)[:, None] ** 2 * (1 + 1e-9)
        border = np.divide(depth, 2 * gap, out=np.zeros_like(d), where=gap > 0)
        near = (cells.size > 0) & (d * (1 - 1e-9) - cells.radius[None, :] * (1 + 1e-9) <= limit) & (border <= limit + 1e-7)
        yield np.arange(at, at + len(part)), near


def _blocks(
    pts: DataFrame, placed: DataFrame, cells: Cells, reach: Callable[[np.ndarray, pd.DataFrame], np.ndarray], block: int, half: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the same (zone, part, lot): `part` cuts the data of a zone, `lot` its visitors. A visitor has in
    `bits` the cells of the zone that may hold a row within `reach` of it, a data row in `nth` its cell's place there.

    `half` is for rows that all meet each other: `pts` are the rows of `placed`, with their cell, and visit their own zone,
    told by `own`, and those after it. Where they are not at home their pairs are met once and count for both rows."""
    zones, block = cells.zones(block * ZONE), block * ZONE
    zone_of, nth = np.zeros(len(cells.size), int), np.zeros(len(cells.size), int)
    for z, members in enumerate(zones):
        zone_of[members], nth[members] = z, np.arange(len(members))
    shared = pts.sparkSession.sparkContext.broadcast((cells, _distances(cells.pivots, cells.pivots), zones, zone_of))

    def homes(b: pd.DataFrame, zone_of: np.ndarray) -> np.ndarray:
        return zone_of[b["cell"].to_numpy()] if half else np.full(len(b), -1)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, between, zones, zone_of = shared.value
        total = np.zeros(len(zones), np.int64)
        for b in batches:
            home = homes(b, zone_of)
            for rows, near in _near(b, c, between, reach):
                total += [int((near[:, m].any(1) & (home[rows] <= z)).sum()) for z, m in enumerate(zones)]
        yield pd.DataFrame({"zone": np.arange(len(zones), dtype=np.int32), "n": total})

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, between, zones, zone_of = shared.value
        for b in batches:
            held: list[pd.DataFrame] = []
            home = homes(b, zone_of)
            for rows, near in _near(b, c, between, reach):
                for z, m in enumerate(zones):
                    at = near[:, m]
                    some = np.flatnonzero(at.any(1) & (home[rows] <= z))
                    if len(some):
                        bits = np.packbits(at[some], axis=1)
                        own = {"own": home[rows[some]] == z} if half else {}
                        held.append(b.iloc[rows[some]].assign(zone=np.int32(z), bits=[r.tobytes() for r in bits], **own))
                    if sum(map(len, held)) >= 4 * BLOCK:
                        yield pd.concat(held)
                        held = []
            if held:
                yield pd.concat(held)

    visitors = [0] * len(zones)
    counted = pts.mapInPandas(count, "zone int, n bigint").groupBy("zone").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # a row per zone
        visitors[r["zone"]] = r["n"]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pts.schema.fields)
    visits = pts.mapInPandas(visit, f"{columns}, zone int, bits binary" + ", own boolean" * half)
    ints = lambda values: F.array(*[F.lit(int(v)) for v in values or [0]])
    n_parts = F.element_at(ints([max(1, -(-int(cells.size[m].sum()) // block)) for m in zones]), F.col("zone") + 1)
    n_lots = F.element_at(ints([max(1, -(-n // block)) for n in visitors]), F.col("zone") + 1)
    spread = F.xxhash64(F.col("id"), F.lit(7))
    left = visits.withColumn("lot", F.pmod(spread, n_lots).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
    at = lambda values: F.element_at(ints(values.tolist()), F.col("cell") + 1)
    right = placed.withColumn("zone", at(zone_of)).withColumn("nth", at(nth)).withColumn("part", F.pmod(spread, n_parts).cast("int"))
    return left, right.withColumn("lot", F.explode(F.sequence(F.lit(0), n_lots - 1)))


def _compare(left: DataFrame, right: DataFrame, fn, schema: str, block: int = BLOCK, merge=None) -> DataFrame:
    """`fn(a, b, x, y, both)` of every piece a of visitors, with vectors x, and the piece b of the cells that they visit, with
    vectors y; `both` says that the pairs are met here only (`half` of _blocks) and count for the rows of b as well. `merge`
    brings the results of a block together, in its task."""
    on = ["zone", "part", "lot"]

    def pieces(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            b = b.iloc[np.argsort(b["nth"].to_numpy(), kind="stable")]
            x, y = _matrix(a["v"]), _matrix(b["v"])
            bits = np.stack([np.frombuffer(t, np.uint8) for t in a["bits"]])
            cells, first, size = np.unique(b["nth"].to_numpy(), return_index=True, return_counts=True)
            own = a["own"].to_numpy(bool) if "own" in a else np.ones(len(a), bool)
            a, b = a.drop(columns=["v", "bits"]), b.drop(columns="v")
            for home in (True, False):
                rows = np.flatnonzero(own == home)
                if not len(rows):
                    continue
                hits = [np.flatnonzero(bits[rows, c >> 3] & (128 >> (c & 7))) for c in cells]
                at = [np.arange(i, i + n) for i, n in zip(first, size)]
                # cells that most rows visit are compared with all of them, in pieces of many cells
                wide = [2 * len(h) >= len(rows) for h in hits]
                jobs = [(rows[h], c) for h, c, w in zip(hits, at, wide) if not w]
                if any(wide):
                    jobs.append((rows, np.concatenate([c for c, w in zip(at, wide) if w])))
                for r, c in jobs:
                    for i in range(0, len(r), block):
                        p = r[i: i + block]
                        pa, px = a.iloc[p], x[p]
                        for j in range(0, len(c), block):
                            q = c[j: j + block]
                            out.append(fn(pa, b.iloc[q], px, y[q], not home))
        out = [t for t in out if len(t)]
        got = pd.concat(out, ignore_index=True) if out else fn(a.iloc[:0], b.iloc[:0], None, None, False)
        return merge(got) if merge and len(got) else got

    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(pieces, schema)


def nearest(
    queries: DataFrame, data: DataFrame, key: str, feats: str | list, k: int, exclude_self: bool = False, block: int = BLOCK
) -> DataFrame:
    """(key, neighbor, distance, rank): the k nearest rows of `data` for each row of `queries`, exact, ties by key."""
    take = k + 1 if exclude_self else k
    placed, cells = build_cells(points(data, key, feats), take)
    closest = cells.closest

    def reach(d: np.ndarray, _: pd.DataFrame) -> np.ndarray:
        # the take-th smallest of (distance to a pivot + distances inside its cell) is an upper bound
        upper = (d[:, :, None] + closest[None, :, :]).reshape(len(d), -1)
        if upper.shape[1] < take:
            return np.full(len(d), np.inf)
        return np.partition(upper, take - 1, axis=1)[:, take - 1]

    left, right = _blocks(points(queries, key, feats), placed, cells, reach, block)
    id_type = data.schema[key].dataType.simpleString()

    def top(a: pd.DataFrame, b: pd.DataFrame, qv: np.ndarray, dv: np.ndarray, _: bool) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "neighbor": [], "distance": []})
        ids = b["id"].to_numpy()
        rough = _distances(qv, dv)
        last = min(len(ids), take) - 1
        bound = np.partition(rough, last, axis=1)[:, last] * (1 + 1e-9)
        out_q, out_n, out_d = [], [], []
        for i, q in enumerate(a["id"].to_numpy()):
            pick = np.flatnonzero(rough[i] <= bound[i])  # every row that may be among the first, ties included
            if exclude_self:
                pick = pick[ids[pick] != q]
            exact = np.sqrt(((qv[i] - dv[pick]) ** 2).sum(1))
            order = np.lexsort((ids[pick], exact))[:k]
            out_q.append(np.repeat(q, len(order)))
            out_n.append(ids[pick][order])
            out_d.append(exact[order])
        return pd.DataFrame({"id": np.concatenate(out_q), "neighbor": np.concatenate(out_n), "distance": np.concatenate(out_d)})

    def first(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["id", "distance", "neighbor"])
        return t[t.groupby("id").cumcount() < k]

    found = _compare(left, right, top, f"id {id_type}, neighbor {id_type}, distance double", block, first)
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbor"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).withColumnRenamed("id", key)
