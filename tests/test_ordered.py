"""Ranks, running sums and quantiles: the wide forms agree with a plain sort whatever the bins."""

import numpy as np
from pyspark.sql import functions as F

from larkspur.operators import ordered


def test_quantiles_narrowed_equal_builtin_and_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if i % 3 else "b", float(x)) for i, x in enumerate(np.concatenate([rng.normal(size=400), np.full(200, 0.25), [1e9, -1e9]]))]
    rows += [("a", None), (None, 3.5), (None, 4.5)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    plain = {r["g"]: r["q"] for r in df.groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, probs))).alias("q")).collect()}
    whole = {r["g"]: r["q"] for r in ordered.exact_quantiles(df, ["x"], probs, by=["g"]).collect()}
    narrow = {r["g"]: r["q"] for r in ordered.exact_quantiles(df, ["x"], probs, by=["g"], sketch=20, grid=16, lot=40).collect()}
    assert set(plain) == {"a", "b", None} == set(narrow) == set(whole)
    for g in plain:
        want = np.quantile([x for k, x in rows if k == g and x is not None], probs)
        assert np.allclose(plain[g], want) and np.allclose(narrow[g], want) and np.allclose(whole[g], want)


def test_quantiles_of_many_values_in_several_reads(spark):
    """A hot group, ties at the wanted ranks, NaN and infinity as the largest values, a column without values."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=30_000), np.full(6_000, 0.5), np.full(300, np.inf), np.full(200, np.nan)])
    g = np.where(rng.random(len(x)) < 0.9, 0, rng.integers(1, 40, len(x)))
    df = spark.createDataFrame(list(zip(g.tolist(), x.tolist(), (x * 3).round(1).tolist())), "g int, x double, y double").withColumn("z", F.lit(None).cast("int")).repartition(5)
    probs = [0.0, 0.001, 0.25, 0.3333, 0.5, 0.69, 0.9, 0.98, 1.0]
    for sizes in ({}, {"sketch": 500}, {"sketch": 100, "grid": 16, "lot": 200}):
        got = {(r["g"], r["column"]): r["q"] for r in ordered.exact_quantiles(df, ["x", "y", "z"], probs, by=["g"], **sizes).collect()}
        assert len(got) == 3 * len(set(g)) and all(q is None for (_, c), q in got.items() if c == "z")
        for k in set(g):
            for c, v in (("x", x), ("y", (x * 3).round(1))):
                v = np.sort(v[g == k])  # NaN last
                at = np.array(probs) * (len(v) - 1)
                lo, hi = v[np.floor(at).astype(int)], v[np.ceil(at).astype(int)]
                with np.errstate(invalid="ignore"):
                    want = np.where(lo == hi, lo, lo + (hi - lo) * (at - np.floor(at)))
                assert np.allclose(got[k, c], want, equal_nan=True), (k, c, sizes)
    assert ordered.exact_quantiles(df.limit(0), ["x"], probs).collect() == []


def test_hash_rank_is_a_rank_per_group_with_nulls(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("g"))
    rows = ordered.hash_rank(df, "id", 5, ["g"], size="n", bits=3).withColumn("h", ordered.hash_order("id", 5)).collect()
    assert len(rows) == 500
    for g in (None, "1", "2"):
        part = sorted((r for r in rows if r["g"] == g), key=lambda r: (r["h"], r["id"]))
        assert [r["rank"] for r in part] == list(range(len(part)))
        assert {r["n"] for r in part} == {len(part)}


def test_position_of_strings_and_numbers(spark):
    for col in (F.col("id"), F.concat(F.lit("k"), F.md5(F.col("id").cast("string")))):
        rows = ordered.position(spark.range(300).select(col.alias("k")), "k", bins=7).collect()
        assert [r["k"] for r in sorted(rows, key=lambda r: r["position"])] == sorted(r["k"] for r in rows)
        assert sorted(r["position"] for r in rows) == list(range(300))


def test_running_sums_both_ways(spark):
    df = spark.range(100).select((F.col("id") * 1.5).alias("x"), F.lit(1).alias("n"))
    up = ordered.running_sums(df, [], "x", ["n"], [10.0, 60.0]).collect()
    down = ordered.running_sums(df, [], "x", ["n"], [10.0, 60.0], descending=True).collect()
    assert all(r["cum_n"] == r["x"] / 1.5 + 1 for r in up)
    assert all(r["cum_n"] == 100 - r["x"] / 1.5 for r in down)


def test_bounds_of_few_groups_go_to_the_rows(spark, capsys):
    """Else all rows of a group meet in one task: the shuffle stays where most partitions of the bounds are empty."""
    df = spark.range(0, 4000, 1, 6).select((F.col("id") % 2).alias("g"), (F.col("id") * 7 % 4000).cast("double").alias("v"))
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ordered.exact_quantiles(df, ["v"], [0.0, 0.5, 1.0], by=["g"])
        out.explain()
        rows = sorted((r["g"], r["q"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert capsys.readouterr().out.count("BroadcastHashJoin") == 2
    for g, q in rows:
        values = sorted(i * 7 % 4000 for i in range(g, 4000, 2))
        assert q == [values[0], (values[999] + values[1000]) / 2, values[-1]]
