"""Density clusters for a whole grid of (eps, min_samples), from levels instead of one run per pair.

The eps values, ascending, cut distances into levels: a distance has the level of the first eps that reaches
it. Everything DBSCAN asks is then a comparison of small numbers:

- a row is core at (eps_i, m) if at least m rows lie within level i; the level at which it becomes core for m
  follows from one count of neighbours per level;
- two rows are linked at (eps_i, m) if the greatest of their distance's level and their two core levels is at
  most i; the clusters are the components of that graph, and any spanning forest of least levels has them all;
- a row that isn't core at (eps_i, m) is border if some core row of that pair lies within level i.

So two passes over the block pairs of the largest eps serve every pair of the grid: one counts neighbours per
level, each pair once, the other returns from each block pair a least spanning forest for each m (at most one edge per
row) and the level at which each row becomes border. Before the second some rows tell which others hang together anyway
(see forest); these need not meet all. No pair of rows leaves a task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from larkspur.models.cluster import components
from larkspur.models.forest import least_forest, levels, neighbour_counts, settled, spanning
from larkspur.operators.neighbors import BLOCK, ZONE, _blocks, _compare, build_cells, points
from larkspur.session import settle


def density_levels(df: DataFrame, key: str, feats, epss: Sequence[float], ms: Sequence[int], block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What every pair's clusters follow from: rows (id, v, weight, core[], border[]), one per distinct vector;
    links (k, level, a, b), each from its level on; and the membership (key, v) of the rows of `df`.

    core[k] and border[k] are the levels at which the row becomes core and border for ms[k]; len(epss) is never, and a
    border level that is not below the core level is not worked out.
    """
    eps = np.array(sorted({float(e) for e in epss}))
    if not len(eps) or not len(ms) or len(eps) > 120 or min(ms) < 1:
        raise ValueError("needs at least one eps (at most 120) and min_samples of 1 or more")
    top, many = len(eps), len(ms)
    pts = points(df, key, feats)
    reps = settle(pts.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight")))
    id_type = reps.schema["id"].dataType.simpleString()
    placed, cells = build_cells(reps, 0)
    reach = lambda d, _: np.full(len(d), eps[-1])
    left, right = _blocks(placed.select("id", "v", "weight", "cell"), placed.select("id", "v", "weight", "cell"), cells, reach, block, True)
    names = [f"n{i}" for i in range(top)]

    def count(a: pd.DataFrame, b: pd.DataFrame, x: np.ndarray, y: np.ndarray, both: bool) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], **{n: [] for n in names}})
        of_a, of_b = neighbour_counts(x, y, a["weight"].to_numpy(), b["weight"].to_numpy(), eps, both)
        out = []
        for t, n in ((a, of_a), (b, of_b))[: 1 + both]:
            some = np.flatnonzero(n[:, -1])
            out.append(pd.DataFrame(n[some], columns=names).assign(id=t["id"].to_numpy()[some]))
        return pd.concat(out)[["id", *names]]

    def add(t: pd.DataFrame) -> pd.DataFrame:
        return t.groupby("id", as_index=False)[names].sum()

    counts = _compare(left, right, count, f"id {id_type}, " + ", ".join(f"{n} bigint" for n in names), block, add)
    sums = counts.groupBy("id").agg(*[F.sum(n).alias(n) for n in names]).join(reps.select("id", "weight"), "id")
    within = F.array(*names)
    level = lambda m: F.size(F.filter(within, lambda n: n < m)).cast("int")  # noqa: E731 - counts rise with the level
    # `met` is the level from which on there is any other row
    core = settle(sums.select("id", F.array(*[level(m) for m in ms]).alias("core"), F.size(F.filter(within, lambda n: n <= F.col("weight"))).alias("met")))
    whole = settle(placed.select("id", "v", "cell").join(core, "id"))
    since, first = settled(whole, eps, many, block, block * ZONE)
    whole = settle(whole.join(since, "id"))
    # a row meets all others if it may be border before it is core, or core before it hangs together with the first
    needed = F.exists(F.arrays_zip("core", "since"), lambda t: (t["core"] < t["since"]) | (F.col("met") < t["core"]))
    left, right = _blocks(whole.where(needed).select("id", "v", "core", "since"), whole.select("id", "v", "core", "since", "cell"), cells, reach, block)

    def forest(a: pd.DataFrame, b: pd.DataFrame, x: np.ndarray, y: np.ndarray, _: bool) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"k": [], "level": [], "a": [], "b": []})
        lev = levels(x, y, eps)
        ids, other = a["id"].to_numpy(), b["id"].to_numpy()
        ca, cb, sa, sb = (np.stack(t[c].to_numpy()).astype(np.int8) for c in ("core", "since") for t in (a, b))
        out = []
        for k in range(many):
            seen = np.maximum(lev, cb[:, k])  # level at which the other row, being core, reaches this one
            border = seen.min(1)
            some = np.flatnonzero((border < top) & (border < ca[:, k]))
            out.append(pd.DataFrame({"k": np.int32(k), "level": border[some].astype(np.int32), "a": ids[some], "b": None}))
            i, j, at = least_forest(np.maximum(seen, ca[:, k][:, None]), top, (sa[:, k], sb[:, k]))
            apart = ids[i] != other[j]
            out.append(pd.DataFrame({"k": np.int32(k), "level": at[apart].astype(np.int32), "a": ids[i[apart]], "b": other[j[apart]]}))
        return pd.concat(out)

    def thin(t: pd.DataFrame) -> pd.DataFrame:
        """The least border level of each row and the least spanning forest of the links, for each of ms."""
        alone = t["b"].isna()
        out = [t[alone].groupby(["k", "a"], as_index=False)["level"].min().assign(b=None)]
        for _, links in t[~alone].groupby("k"):
            out.append(links.iloc[spanning(links["a"].to_numpy(), links["b"].to_numpy(links["a"].dtype), links["level"].to_numpy())])
        return pd.concat(out)[["k", "level", "a", "b"]]

    found = settle(_compare(left, right, forest, f"k int, level int, a {id_type}, b {id_type}", block, thin))
    border = found.where("b is null").groupBy("a", "k").agg(F.min("level").alias("level"))
    border = border.groupBy(F.col("a").alias("id")).agg(*[F.min(F.when(F.col("k") == k, F.col("level"))).alias(f"b{k}") for k in range(many)])
    never = F.lit(top)
    rows = reps.join(core, "id", "left").join(border, "id", "left").select(
        "id", "v", "weight", F.coalesce("core", F.array_repeat(never, many)).alias("core"),
        F.array(*[F.coalesce(f"b{k}", never) for k in range(many)]).alias("border"),
    )
    # an edge holds from its level on
    told = [(k, r) for k, r in enumerate(first) if r is not None]
    links = found.where("b is not null")
    for k, r in told:
        one = whole.select(F.lit(k).alias("k"), F.col("since")[k].alias("level"), F.col("id").alias("a"), F.lit(r).cast(id_type).alias("b"))
        links = links.union(one.where((F.col("level") < top) & (F.col("a") != F.col("b"))))
    edges = links.groupBy("k", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("level").alias("level"))
    return settle(rows), edges.select("k", "level", "a", "b"), pts.select(F.col("id").alias(key), "v")


def level_roots(links: DataFrame, top: int) -> DataFrame:
    """(k, id, level, root): the root of each node from a level on, where it changes at that level; `links` are (k, level, a, b).

    Components only grow from level to level, so a level joins the roots of the one before by its own edges: an edge
    is worked on once, in the first level that holds it, and edges inside a component are gone for good."""
    node = lambda x: F.struct("k", F.col(x).alias("id")).alias(x)
    rest, out, held = settle(links), None, None
    for level in range(top):
        if not rest.where(F.col("level") == level).limit(1).count():
            continue
        roots = components(rest.where(F.col("level") == level).select(node("a"), node("b")))
        roots = settle(roots.select(F.col("node.k").alias("k"), F.col("node.id").alias("id"), F.col("root.id").alias("root")))
        # those that hung on a node which now hangs on another come along
        moved = roots
        if held is not None:
            below = held.join(roots.select("k", F.col("id").alias("old"), F.col("root").alias("new")), [held["k"] == roots["k"], F.col("root") == F.col("old")])
            below = below.select(held["k"], held["id"], F.col("new").alias("root"))
            moved = settle(roots.union(below))
            held = settle(held.join(moved.select("k", "id"), ["k", "id"], "left_anti").union(moved))
        else:
            held = roots
        part = moved.select("k", "id", F.lit(level).alias("level"), "root")
        out = part if out is None else out.union(part)
        rest = rest.where(F.col("level") > level)
        for x in ("a", "b"):
            to = roots.select("k", F.col("id").alias(x), F.col("root").alias("to"))
            rest = rest.join(to, ["k", x], "left").select("k", "level", *[F.coalesce("to", x).alias(x) if c == x else c for c in ("a", "b")])
        rest = settle(rest.where("a <> b").groupBy("k", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("level").alias("level")))
    kind = links.schema["a"].dataType.simpleString()
    return out if out is not None else links.sparkSession.createDataFrame([], f"k int, id {kind}, level int, root {kind}")


def _states(rows: DataFrame, links: DataFrame, epss: Sequence[float], ms: Sequence[int]) -> DataFrame:
    """`rows` once for every pair: eps, min_samples, the row's columns, root and core."""
    many = len(ms)
    # a row's roots by level, for each of ms
    roots = level_roots(links, len(epss)).groupBy("id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("k") == k, F.struct("level", "root")))).alias(f"r{k}") for k in range(many)]  # at most one a level
    )
    return settle(rows.join(roots, "id", "left").withColumn("r", F.array(*[f"r{i}" for i in range(many)])).drop(*[f"r{i}" for i in range(many)]))


def _each(states: DataFrame, epss: Sequence[float], ms: Sequence[int], *keep: str) -> DataFrame:
    many = len(ms)
    at = F.explode(F.sequence(F.lit(0), F.lit(len(epss) * many - 1))).alias("pair")
    k, level = F.col("pair") % many + 1, F.floor(F.col("pair") / many)
    each = states.select("id", "r", "core", "border", *keep, at)
    reached = F.filter(F.element_at("r", k), lambda x: x["level"] <= level)
    root = F.when(F.size(reached) > 0, F.element_at(reached, -1)["root"]).alias("root")
    each = each.select("id", *keep, "pair", (F.element_at("core", k) <= level).alias("core"), (F.element_at("border", k) <= level).alias("border"), root)
    state = F.when(F.col("core"), True).when(F.col("border"), False)
    return each.select(
        F.element_at(F.array(*[F.lit(e) for e in epss]), (level + 1).cast("int")).alias("eps"), F.element_at(F.array(*[F.lit(int(m)) for m in ms]), k.cast("int")).alias("min_samples"),
        "id", *keep, F.when(F.col("core"), F.coalesce("root", "id")).alias("root"), state.alias("core"),
    )


def density_clusters(df: DataFrame, key: str, feats, epss: Sequence[float], ms: Sequence[int], block: int = BLOCK) -> DataFrame:
    """(eps, min_samples, v, weight, root, core): for every pair and distinct vector the smallest core id of its
    component if it is core; a border row has none here but is marked by core = false, noise by null."""
    epss = sorted({float(e) for e in epss})
    rows, links, _ = density_levels(df, key, feats, epss, ms, block)
    return _each(_states(rows, links, epss, ms), epss, ms, "v", "weight")


def sweep_dbscan(df: DataFrame, key: str, feats, epss: Sequence[float], ms: Sequence[int], label: str | None = None, block: int = BLOCK) -> DataFrame:
    """(eps, min_samples, clusters, noise, core_rows[, ari]) for every pair of parameters.

    The adjusted Rand index reads clusters over the core rows; border and noise rows, whose cluster DBSCAN leaves
    to the order of its rows or to none, are each left out of it.
    """
    epss = sorted({float(e) for e in epss})
    rows, links, _ = density_levels(df, key, feats, epss, ms, block)
    states = _states(rows, links, epss, ms)
    out = _each(states, epss, ms, "weight").groupBy("eps", "min_samples").agg(
        F.count_if(F.col("core") & (F.col("root") == F.col("id"))).alias("clusters"),
        F.coalesce(F.sum(F.when(F.col("core").isNull(), F.col("weight"))), F.lit(0)).alias("noise"),
        F.coalesce(F.sum(F.when(F.col("core"), F.col("weight"))), F.lit(0)).alias("core_rows"),
    )
    if not label:
        return out
    told = points(df, label, feats).select("v", F.col("id").alias("y")).groupBy("v", "y").agg(F.count("*").alias("n"))
    labelled = states.join(told, "v").select("id", "r", "core", "border", "y", "n")  # before the grid, which has a row for every pair
    cells = settle(_each(labelled, epss, ms, "y", "n").where("core").groupBy("eps", "min_samples", "root", "y").agg(F.sum("n").alias("n")))
    pairs = lambda n: F.sum(n.cast("double") * (n - 1) / 2)
    on = ["eps", "min_samples"]
    both = cells.groupBy(*on).agg(pairs(F.col("n")).alias("both"), F.sum("n").cast("double").alias("all"))
    for name, by in (("by_root", "root"), ("by_label", "y")):
        both = both.join(cells.groupBy(*on, by).agg(F.sum("n").alias("n")).groupBy(*on).agg(pairs(F.col("n")).alias(name)), on)
    expected = F.col("by_root") * F.col("by_label") / F.nullif(F.col("all") * (F.col("all") - 1) / 2, F.lit(0.0))
    top = (F.col("by_root") + F.col("by_label")) / 2
    ari = F.when(expected.isNull() | (top == expected), 1.0).otherwise((F.col("both") - expected) / (top - expected))
    return out.join(both.select(*on, ari.alias("ari")), on, "left")
