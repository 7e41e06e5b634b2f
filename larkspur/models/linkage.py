"""Bottom-up clustering with Ward's linkage, in rounds that merge all mutually nearest clusters at once.

Merging clusters A and B adds cost(A, B) = |A||B| / (|A| + |B|) * |mean A - mean B|^2 to the spread within clusters.
The linkage is reducible: a merge brings no other pair closer than it was, so pairs that are each other's nearest
can merge in any order, or together, and the tree is that of merging the cheapest pair each time. A round needs
each cluster's mean and size only. Its nearest partner is found exactly over the cells of `neighbors`, with cell
bounds on distance and size; blocks meet in numpy and send on one candidate per cluster. As a merge brings nothing
closer, a partner stays the nearest until it merges or the cluster does: only those that lost theirs look for a new one.
Clusters whose vectors take no more than HELD bytes go whole to every task, and a round is one read. Once they are no
more than a task compares at a time (a zone), one task ends the tree: in many dimensions most clusters point at a few
others, so a round merges few pairs.

Costs are compared with a hash of the pair behind them, so rows on a lattice, all equally far, still pair off by
the third in every round; equal rows merge at height zero before the first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from larkspur.models.cluster import components
from larkspur.operators.neighbors import BLOCK, SLAB, ZONE, Rough, _blocks, _compare, _distances, _matrix, build_cells, points
from larkspur.session import settle

HELD = 1 << 26  # bytes of vectors that are sent whole to every task


def _tie(a, b) -> int:
    """The same for both orders of a pair."""
    return zlib.crc32(repr((min(a, b), max(a, b))).encode())


def _plain(x):
    return x.item() if hasattr(x, "item") else x


def _first(rows: np.ndarray, names, others, cost: np.ndarray) -> np.ndarray:
    """Places of the least cost of each row, of equal ones that of the least hash."""
    order = np.lexsort((cost, rows))
    start = np.flatnonzero(np.diff(rows[order], prepend=-1))
    size, keep = np.diff(start, append=len(rows)), order[start]
    next_ = order[np.minimum(start + 1, len(rows) - 1)]
    for k in np.flatnonzero((size > 1) & (cost[next_] == cost[keep])):
        at = order[start[k]: start[k] + size[k]]
        keep[k] = min(at[cost[at] == cost[keep[k]]], key=lambda p: (_tie(_plain(names[p]), _plain(others[p])), _plain(others[p])))
    return keep


def _cheapest(
    x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, ids: np.ndarray, other: np.ndarray, rough: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, cost): for the clusters (x, n) of `ids` the one that costs least of the clusters (y, m) of `other`,
    itself left out. Costs in single precision, with a bound on what they lose, leave few pairs to work out."""
    n, m = n.astype(np.float64), m.astype(np.float64)
    close, same, pairs = Rough(x, y), np.isin(ids, other), []
    rough = rough and close.sound
    for at in range(0, len(x), SLAB):
        s = slice(at, at + SLAB)
        if rough:
            cost = close.left[s] @ close.right
            cost /= (1 / n[s]).astype(np.float32)[:, None] + (1 / m).astype(np.float32)[None, :]
            lost = 2 * close.off / (1 / n[s] + 1 / m.max())
        else:
            cost, lost = _distances(x[s], y) ** 2 * (n[s, None] * m[None, :] / (n[s, None] + m[None, :])), 0.0
        for i in np.flatnonzero(same[s]):
            cost[i, other == ids[at + i]] = np.inf
        j = cost.argmin(1)
        i = np.arange(len(j))
        low = cost[i, j]
        limit = low + ((1e-6 * np.abs(low) + lost) if rough else 1e-9 * low)
        found = np.flatnonzero(low < np.inf)
        pairs.append((found + at, j[found]))
        cost[i, j] = np.inf
        more = cost <= np.where(low < np.inf, limit, -np.inf).astype(cost.dtype)[:, None]
        some = np.flatnonzero(more.any(1))
        if rough and np.count_nonzero(more) > 64 * len(j):  # too many to tell apart in single precision
            return _cheapest(x, y, n, m, ids, other, False)
        i, j = np.nonzero(more[some])
        pairs.append((some[i] + at, j))
    rows, places = (np.concatenate(t) for t in zip(*pairs))
    exact = np.empty(len(rows))
    for at in range(0, len(rows), 1 << 16):
        i, j = rows[at: at + (1 << 16)], places[at: at + (1 << 16)]
        exact[at: at + (1 << 16)] = ((x[i] - y[j]) ** 2).sum(1) * (n[i] * m[j] / (n[i] + m[j]))
    keep = _first(rows, ids[rows], other[places], exact)
    return rows[keep], places[keep], exact[keep]


def _partners(clusters: DataFrame, block: int, some: DataFrame | None = None) -> DataFrame:
    """(a, b, cost) with the cheapest partner b of every cluster a, or of `some` of them."""
    placed, cells = build_cells(clusters.select("id", "v", "n"), 2)
    least = np.ones(len(cells.size))  # the smallest cluster of each cell
    sizes = placed.groupBy("cell").agg(F.min("n").alias("low"), F.max("n").alias("high")).collect()  # a row per cell
    for r in sizes:
        least[r["cell"]] = r["low"]
    most, closest = max(r["high"] for r in sizes), cells.closest

    def reach(d: np.ndarray, b: pd.DataFrame) -> np.ndarray:
        """How far the cluster's cheapest partner may lie in each cell."""
        n = b["n"].to_numpy().astype(np.float64)
        # the second smallest bound, as the smallest may be the cluster itself
        upper = (d[:, :, None] + closest[None, :, :]).reshape(len(d), -1)
        far = np.partition(upper, 1, axis=1)[:, 1] if upper.shape[1] > 1 else np.full(len(d), np.inf)
        cost = far**2 * n * most / (n + most)
        part = n[:, None] * least[None, :] / (n[:, None] + least[None, :])
        return np.sqrt(cost[:, None] / np.maximum(part, 1e-300))

    pts = (clusters if some is None else some).select(*[F.col(c).alias(c) for c in ("id", "v", "n")])
    left, right = _blocks(pts, placed.select("id", "v", "n", "cell"), cells, reach, block)
    kind = clusters.schema["id"].dataType.simpleString()

    def best(a: pd.DataFrame, b: pd.DataFrame, x: np.ndarray, y: np.ndarray, _: bool) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": [], "cost": [], "tie": []})
        ids, other = a["id"].to_numpy(), b["id"].to_numpy()
        i, j, cost = _cheapest(x, y, a["n"].to_numpy(), b["n"].to_numpy(), ids, other)
        return pd.DataFrame({"a": ids[i], "b": other[j], "cost": cost, "tie": 0})

    def first(t: pd.DataFrame) -> pd.DataFrame:
        t = t.iloc[_first(pd.factorize(t["a"])[0], t["a"].to_numpy(), t["b"].to_numpy(), t["cost"].to_numpy())]
        return t.assign(tie=[_tie(a, b) for a, b in zip(t["a"].tolist(), t["b"].tolist())])

    found = _compare(left, right, best, f"a {kind}, b {kind}, cost double, tie bigint", block, first)
    return found.groupBy("a").agg(F.min(F.struct("cost", "tie", "b")).alias("m")).select("a", "m.b", "m.cost")


def _held_rounds(spark, ids: np.ndarray, v: np.ndarray, n: np.ndarray, mate: np.ndarray, cost: np.ndarray, end: int, chain: int, block: int, rounds: int) -> tuple[list, tuple]:
    """([(a, b, cost) as columns, for each round], the clusters left), from clusters few enough to be sent whole to every
    task, sorted by id; `mate` has the place of each one's cheapest partner, or -1. In a round the tasks look for the
    partners that the last one's merges took away. Ends with `end` clusters, or with `chain` where rounds merge few pairs."""
    out, tasks, anew = [], 2 * spark.sparkContext.defaultParallelism, False
    for _ in range(rounds):
        if len(ids) <= end:
            return out, (ids, v, n)
        at = np.arange(len(ids))
        a = np.flatnonzero((mate > at) & (mate[mate] == at))
        b = mate[a]
        if len(a) * 64 < len(ids) <= chain:
            return out, (ids, v, n)
        out.append((ids[a], ids[b], cost[a]))
        touched = np.zeros(len(ids), bool)
        touched[a], touched[b] = True, True
        v[a] = (n[a, None] * v[a] + n[b, None] * v[b]) / (n[a] + n[b])[:, None]
        n[a] += n[b]
        if not len(a) and anew:
            break
        anew = not len(a)  # equal costs only: they are told by their hash where all partners are looked for at once
        stale = touched | (mate < 0) | touched[mate] | anew
        kept = np.ones(len(ids), bool)
        kept[b] = False
        place = np.where(kept, np.cumsum(kept) - 1, -1)
        ids, v, n, mate, cost, stale = ids[kept], v[kept], n[kept], place[mate[kept]], cost[kept], np.flatnonzero(stale[kept])
        mate[stale] = -1
        shared = spark.sparkContext.broadcast((ids, v, n, stale))

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, v, n, stale = shared.value
            for task in (int(t) for t_ in batches for t in t_["id"]):
                mine = stale[task::tasks]
                for i in range(0, len(mine), block):
                    p, got = mine[i: i + block], []
                    for j in range(0, len(ids), block):
                        q = slice(j, j + block)
                        r, c, low = _cheapest(v[p], v[q], n[p], n[q], ids[p], ids[q])
                        got.append((r, c + j, low))
                    r, c, low = (np.concatenate(t) for t in zip(*got))
                    k = _first(r, ids[p[r]], ids[c], low)
                    yield pd.DataFrame({"a": p[r[k]], "b": c[k], "cost": low[k]})

        found = spark.range(0, tasks, 1, tasks).mapInPandas(look, "a bigint, b bigint, cost double").toPandas()
        shared.destroy()
        mate[found["a"].to_numpy()], cost[found["a"].to_numpy()] = found["b"].to_numpy(), found["cost"].to_numpy()
    raise RuntimeError("the clusters did not come down to one zone")


def _chain(ids: np.ndarray, v: np.ndarray, n: np.ndarray) -> Iterator[tuple]:
    """All merges of a few clusters, following nearest neighbours until two point at each other. Costs come from products
    around the centre, with a bound on what they lose; those that may be the least are worked out by differences."""
    v, n, live, chain = v.copy(), n.astype(np.float64), np.ones(len(ids), bool), []
    with np.errstate(all="ignore"):
        centre = v.mean(0)
        x = v - centre
        norm = (x * x).sum(1)
    sound = bool(np.isfinite(norm).all())  # else products tell nothing
    slack = 1e-15 * (v.shape[1] + 16)
    for left in range(len(ids), 1, -1):
        if 2 * left < len(ids):  # the dead ones go, the others keep their order
            place, live = np.cumsum(live) - 1, np.flatnonzero(live)
            chain = [int(place[i]) for i in chain]
            ids, v, n, x, norm = (t[live] for t in (ids, v, n, x, norm))
            live = np.ones(left, bool)
        while True:
            if not chain:
                chain = [int(np.flatnonzero(live)[0])]
            a = chain[-1]
            part, open_ = n * n[a] / (n + n[a]), live.copy()
            open_[a] = False
            if sound:
                both = norm + norm[a]
                rough, lost = (both - 2.0 * (x @ x[a])) * part, both * part * slack
                rough[~open_] = np.inf
                open_ = rough - lost <= (rough + lost).min()
            pick = np.flatnonzero(open_)
            cost = ((v[pick] - v[a]) ** 2).sum(1) * part[pick]
            low = float(cost.min())
            b = int(pick[cost.argmin()])
            if len(chain) > 1 and (b == chain[-2] or chain[-2] in pick[cost == low]):
                b = chain[-2]
                break
            chain.append(b)
        chain = chain[:-2]
        a, b = sorted((a, b), key=lambda i: ids[i])
        yield ids[a], ids[b], low
        v[a] = (n[a] * v[a] + n[b] * v[b]) / (n[a] + n[b])
        if sound:
            x[a] = v[a] - centre
            norm[a] = x[a] @ x[a]
        n[a] += n[b]
        live[b] = False


def ward_merges(df: DataFrame, key: str, feats, block: int = BLOCK, rounds: int = 1000) -> DataFrame:
    """(a, b, height): one row for each merge, named by the smallest keys of the two clusters, a < b.

    height is sqrt(2 * cost): for two rows their distance. Heights never fall from a merge to the next one that holds
    it. Rows of equal vectors merge at height 0; rows whose vector is null or holds a null or NaN are left out.
    """
    pts = points(df, key, feats).where("v is not null and not exists(v, x -> x is null or isnan(x))")
    clusters = settle(pts.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", "v", "n"))
    kind = clusters.schema["id"].dataType.simpleString()
    same = pts.join(clusters.select("v", F.col("id").alias("a")), "v").where(F.col("id") > F.col("a"))
    out = same.select("a", F.col("id").alias("b"), F.lit(0.0).alias("height"))
    height = F.sqrt(2 * F.col("cost")).alias("height")
    dim = clusters.select(F.max(F.size("v"))).first()[0] or 1
    best = None
    for done in range(rounds):
        size = clusters.count()
        if size <= block * ZONE:
            break
        if best is None:
            best = settle(_partners(clusters, block))
        else:
            stale = clusters.join(best.select(F.col("a").alias("id")), "id", "left_anti").select("id", "v", "n")
            best = settle(best.union(_partners(clusters, block, stale)))
        if size * dim * 8 <= HELD:
            t = clusters.join(best.withColumnRenamed("a", "id"), "id", "left").select("id", "n", "b", "cost", "v").toPandas().sort_values("id")
            ids, mates = t["id"].to_numpy(), t["b"].to_numpy()
            mate = pd.Index(ids).get_indexer(mates)
            held, (ids, v, n) = _held_rounds(
                clusters.sparkSession, ids, _matrix(t["v"]), t["n"].to_numpy().astype(np.float64), mate, t["cost"].to_numpy(), 2 * block, block * ZONE, block, rounds - done
            )
            held.append(tuple(np.array(c) for c in zip(*_chain(ids, v, n))))
            table = pd.concat([pd.DataFrame(dict(zip(("a", "b", "cost"), c))) for c in held if len(c) and len(c[0])])
            last = clusters.sparkSession.createDataFrame(table, f"a {kind}, b {kind}, cost double")
            return out.unionByName(last.select("a", "b", height))
        back = best.select(F.col("a").alias("b"), F.col("b").alias("a"), F.lit(1).alias("mutual"))
        merges = settle(best.join(back, ["a", "b"]).where("a < b").select("a", "b", "cost"))
        out = out.unionByName(merges.select("a", "b", height))
        side = lambda x: clusters.select(F.col("id").alias(x), F.col("v").alias(f"v{x}"), F.col("n").alias(f"n{x}"))
        joined = merges.select("a", "b").join(side("a"), "a").join(side("b"), "b")
        mean = F.zip_with("va", "vb", lambda x, y: (x * F.col("na") + y * F.col("nb")) / (F.col("na") + F.col("nb")))
        gone = settle(merges.select(F.col("a").alias("id")).union(merges.select("b")))
        rest = clusters.join(gone, "id", "left_anti").select("id", "v", "n")
        clusters = settle(rest.union(joined.select("a", mean, F.col("na") + F.col("nb"))))
        # a partner stays the cheapest until it or the cluster merges; with equal costs only, all are looked for anew
        kept = best.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti").select("a", "b", "cost")
        best = kept if merges.limit(1).count() else None
    else:
        raise RuntimeError("the clusters did not come down to one zone")

    def end(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("id")
        return pd.DataFrame(list(_chain(t["id"].to_numpy(), _matrix(t["v"]), t["n"].to_numpy())), columns=["a", "b", "cost"])

    last = clusters.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(end, f"a {kind}, b {kind}, cost double")  # at most ZONE blocks
    return out.unionByName(last.select("a", "b", height))


def cut_tree(merges: DataFrame, rows: DataFrame, key: str, ks: Sequence[int]) -> DataFrame:
    """(key, k, cluster) for every row and k: the clusters left when the k - 1 highest merges are undone, numbered by
    their smallest key. Of equally high merges those of larger keys are undone first."""
    ks = sorted(set(ks))
    if not ks or ks[0] < 1:
        raise ValueError("k must be 1 or more")
    high = merges.orderBy(F.desc("height"), F.desc("b"), F.desc("a")).limit(ks[-1] - 1).collect()  # bounded by the largest k
    spark = merges.sparkSession
    kind = merges.schema["a"].dataType.simpleString()
    tops = spark.createDataFrame([(r["a"], r["b"]) for r in high], f"a {kind}, b {kind}")
    roots = settle(components(merges.select("a", "b").join(tops, ["a", "b"], "left_anti")))
    named = [x for r in high for x in (r["a"], r["b"])]
    told = {r["node"]: r["root"] for r in roots.where(F.col("node").isin(named)).collect()} if named else {}
    base = sorted({told.get(x, x) for x in named})
    table = []
    for k in ks:
        root = {x: x for x in base}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for r in high[k - 1:]:
            a, b = sorted((find(told.get(r["a"], r["a"])), find(told.get(r["b"], r["b"]))))
            root[b] = a
        firsts = sorted({find(x) for x in base})
        table += [(x, k, firsts.index(find(x))) for x in base]
    src = rows.select(F.col(key).alias("id")).join(roots.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    if not base:  # nothing was undone: one cluster
        return src.select(F.col("id").alias(key), F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"), F.lit(0).alias("cluster"))
    small = spark.createDataFrame(table, f"root {kind}, k int, cluster int")  # at most (largest k)^2 rows
    return src.join(small, "root").select(F.col("id").alias(key), "k", "cluster")
