"""Cleaning, splits and statistics: invariants and edge cases."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import clean, encode, evaluate, joins, profile, split, stats
from larkspur.session import scratch_path
from larkspur.sources import tables


def test_exclude_keeps_null_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    assert {r[0] for r in clean.exclude(df, "a", [1]).collect()} == {None, 3}


def test_autocast_only_all_digit_columns(spark):
    df = spark.createDataFrame([("1", "2", None), ("20", "x", "7")], "a string, b string, c string")
    assert dict(clean.autocast(df).dtypes) == {"a": "bigint", "b": "string", "c": "bigint"}


def test_lookup_with_repeated_key_is_refused(spark):
    df = spark.createDataFrame([(1,)], "k int")
    bad = spark.createDataFrame([(1, "a"), (1, "b")], "k int, d string")
    with pytest.raises(ValueError):
        joins.attach_lookup(df, bad, "k", ["d"])


def test_first_per_key_and_counts_on_a_hot_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"), (1000 - F.col("id")).alias("o"), "id")
    first = {r["k"]: r["id"] for r in clean.first_per_key(df, "k", ["o"]).collect()}
    assert first[1] == 699 and len(first) == 301
    assert clean.count_per_key(df, "k", "n").where("k = 1 and n = 700").count() == 700


def test_stacked_lookup(spark):
    rows = [("1", "Emergency"), ("2", " Urgent"), (None, None), ("discharge_id", "description"), ("1", "Home, care"), (None, None), ("source_id", "description"), ("1", "NULL")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "line int, id string, description string")
    parts = tables.split_stacked_lookup(df, "id", "description", "line", "type_id")
    assert {k: sorted((r["id"], r["description"]) for r in v.collect()) for k, v in parts.items()} == {
        "type_id": [(1, "Emergency"), (2, "Urgent")],
        "discharge_id": [(1, "Home, care")],
        "source_id": [(1, "NULL")],
    }


def test_splits(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    folds = split.kfold_stratified(df, "id", "y", 5)
    sizes = {(r["y"], r["fold"]): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        per = [sizes[(y, f)] for f in range(5)]
        assert max(per) - min(per) <= 1
    assert folds.select("id").distinct().count() == 1003
    parts = split.split_stratified(df, "id", "y", 0.8).groupBy("y", "part").count().collect()
    assert {(r["y"], r["part"]): r["count"] for r in parts}[(1, "train")] == round(101 * 0.8)
    more = split.oversample(df, "id", "y").groupBy("y").count().collect()
    assert len({r["count"] for r in more}) == 1
    fewer = split.undersample(df, "id", "y").groupBy("y").count().collect()
    assert {r["count"] for r in fewer} == {101}


def test_oversample_of_one_row(spark):
    df = spark.range(25_001).select("id", (F.col("id") == 0).cast("int").alias("y"))
    got = split.oversample(df, "id", "y").where("y = 1").agg(F.count("*"), F.count_distinct("copy"), F.min("copy"), F.max("copy")).first()
    assert tuple(got) == (25_000, 25_000, 1, 25_000)


def test_bootstrap_columns_stay_in_order():
    cols = [f"c{i}" for i in range(50)]
    got = split.bootstrap_columns(cols, 0.64, 3)
    assert len(got) == 32 and got == sorted(got, key=cols.index)


def test_correlation_counts_pairs_at_any_width(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 20))
    m[:, 5] += m[:, 4]
    m[:, 19] = 2.5  # no variance
    hole = rng.random(m.shape) < 0.2
    cols = [f"c{i}" for i in range(20)]
    rows = [[None if h else float(x) for x, h in zip(r, g)] for r, g in zip(m, hole)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = {(r["a"], r["b"]): r["r"] for r in encode.corr_matrix(df, cols).collect()}
    assert len(got) == 190
    for i in range(20):
        for j in range(i + 1, 20):
            both = ~hole[:, i] & ~hole[:, j]
            r = got[f"c{i}", f"c{j}"]
            assert (r is None) if j == 19 else abs(r - np.corrcoef(m[both, i], m[both, j])[0, 1]) < 1e-9
    few = {(r["a"], r["b"]): r["r"] for r in encode.corr_matrix(df, cols[:4]).collect()}
    assert all(abs(got[k] - few[k]) < 1e-12 for k in few)
    assert {r["column"] for r in encode.select_by_target_corr(df, ["c4", "c19"], "c5").collect()} == {"c4"}


def test_crosstab_finds_or_refuses_values(spark):
    rows = [("p", "x")] * 3 + [("p", "y")] * 4 + [("All", "x")] * 2 + [("q", None), (None, "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [tuple(r) for r in stats.crosstab(df, "a", "b").collect()] == [("All", 2, 0), ("p", 3, 4)]
    wide = stats.crosstab(df, "a", "b", margins=True)
    assert wide.columns == ["a", "x", "y", "All"]
    assert sorted(tuple(r) for r in wide.collect()) == [("All", 2, 0, 2), ("All", 5, 4, 9), ("p", 3, 4, 7)]
    with pytest.raises(Exception, match="not listed: y"):
        stats.crosstab(df, "a", "b", ["x"]).collect()
    with pytest.raises(ValueError):
        stats.crosstab(df, "b", "a", margins=True)


def test_yeo_johnson_finds_the_log(spark):
    # exp of a normal-like grid: lambda 0 on 1 + x makes it symmetric
    rows = [(math.exp(z) - 1,) for z in [i / 50 for i in range(1, 201)]]
    df = spark.createDataFrame(rows, "x double")
    lam = encode.fit_yeo_johnson(df, "x")
    grid = [lam + d for d in (-0.05, 0.0, 0.05)]
    ll = {r["lam"]: r["loglik"] for r in encode.yeo_johnson_profile(df, "x", grid).collect()}
    assert ll[grid[1]] >= max(ll.values()) - 1e-9
    out = encode.apply_yeo_johnson(df, "x", lam, "y").agg(F.avg("y"), F.stddev_pop("y")).first()
    assert abs(out[0]) < 1e-9 and abs(out[1] - 1) < 1e-9


def test_pca_orthonormal_and_ordered(spark, sf):
    import numpy as np
    from pyspark.ml.functions import array_to_vector

    t = spark.read.parquet(f"{sf}/embeddings.parquet").select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    m = encode.fit_pca(t, "v", share=0.95).stages[-1]
    pc, ev = m.pc.toArray(), m.explainedVariance.toArray()
    assert np.allclose(pc.T @ pc, np.eye(pc.shape[1]), atol=1e-8)
    assert (np.diff(ev) <= 1e-12).all() and ev.sum() >= 0.95 > ev[:-1].sum()


def test_chi_square_p():
    assert abs(stats.chi_square_p(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(stats.chi_square_p(18.307038053275146, 10) - 0.05) < 1e-9
    assert abs(stats.chi_square_p(1.0, 2) - math.exp(-0.5)) < 1e-12


def test_chi_square_counts_empty_cells(spark):
    df = spark.createDataFrame([("a", "x")] * 10 + [("b", "y")] * 5 + [("c", "x")] * 5, "a string, b string")
    r = stats.chi_square(df, "a", "b").first()
    assert abs(r["statistic"] - 20.0) < 1e-9 and r["dof"] == 2
    # 2x2 with an empty cell: expected 2.8, 4.2, 1.2, 1.8 and |n - e| = 1.2 everywhere
    df = spark.createDataFrame([("a", "x")] * 4 + [("a", "y")] * 3 + [("b", "y")] * 3, "a string, b string")
    right = sum(0.7**2 / e for e in (2.8, 4.2, 1.2, 1.8))
    assert abs(stats.chi_square(df, "a", "b").first()["statistic"] - right) < 1e-9


def test_columns_of(spark):
    df = spark.createDataFrame([(1, 2.0, "a", True)], "i int, d double, s string, b boolean")
    assert profile.columns_of(df, "numeric") == ["i", "d"]
    assert profile.columns_of(df, "string") == ["s"] and profile.columns_of(df, "boolean") == ["b"]


def test_csv_round_trip(spark, sf):
    t = spark.read.parquet(f"{sf}/part.parquet")
    path = scratch_path(spark, "csv")
    tables.write_table(t, path, "csv")
    again = tables.read_table(spark, path, t.schema)
    assert again.exceptAll(t).isEmpty() and t.exceptAll(again).isEmpty()


def test_chi_square_p_column(spark):
    df = spark.createDataFrame([("a", "x")] * 30 + [("a", "y")] * 10 + [("b", "x")] * 10 + [("b", "y")] * 30, "a string, b string")
    r = stats.with_p_value(stats.chi_square(df, "a", "b", yates=False)).first()
    assert abs(r["statistic"] - 20.0) < 1e-9 and abs(r["p_value"] - math.erfc(math.sqrt(10.0))) < 1e-12
    one = stats.with_p_value(stats.chi_square(df.where("a = 'a'"), "a", "b")).first()
    assert one["dof"] == 0 and one["p_value"] is None


def test_stacked_lookup_of_many_rows(spark):
    """Sections that open in one bin and end many bins on, one without rows, blank rows between."""
    opens = {0: "one", 1: "two", 700: "three", 5000: "four", 5001: "five"}
    line = F.col("id").cast("int")
    names = F.create_map(*[F.lit(x) for kv in opens.items() for x in kv])
    key = F.when(F.pmod("id", F.lit(10)) == 9, None).otherwise(F.coalesce(F.try_element_at(names, line), F.col("id").cast("string")))
    df = spark.range(-3, 20_000, 1, 8).select(line.alias("line"), key.alias("id"), F.lit("x").alias("description"))
    parts = tables.split_stacked_lookup(df, "id", "description", "line", "zero")
    want, name = {}, "zero"
    for i in range(-3, 20_000):
        if i in opens:
            name = opens[i]
        elif i % 10 != 9:
            want.setdefault(name, set()).add(i)
    assert {k: {r["id"] for r in v.collect()} for k, v in parts.items()} == want


def test_confusion_takes_the_classes_of_the_data(spark):
    rows = [("a", "a"), ("a", "b"), ("c", "a"), (None, "a"), (None, "a"), ("b", None)]
    pred = spark.createDataFrame(rows, "label string, prediction string")
    got = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(pred, ["d"]).collect()}
    assert {k: n for k, n in got.items() if n} == {("a", "a"): 1, ("a", "b"): 1, ("c", "a"): 1, (None, "a"): 2, ("b", None): 1}
    assert {k for k in got if None not in k} == {(x, y) for x in "abcd" for y in "abcd"}
    assert evaluate.confusion(pred.limit(0)).count() == 0


def test_shapiro_francia(spark):
    """Against normal scores from the standard library, with a value that holds a third of the rows."""
    from statistics import NormalDist

    rng = np.random.default_rng(2)
    for x in (rng.normal(size=300), rng.exponential(size=200), np.concatenate([np.full(100, 1.0), rng.normal(size=200)])):
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(999, None)], "id long, x double")
        got = stats.shapiro_francia(df, "id", "x").first()
        n = len(x)
        m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
        d = np.sort(x) - x.mean()
        want = (m @ d) ** 2 / ((m @ m) * (d @ d))
        assert got["n"] == n and abs(got["statistic"] - want) < 1e-8
        assert (got["p_value"] > 0.01) == (got["statistic"] > 0.98) and abs(got["p_value"] - (1 - NormalDist().cdf(got["z"]))) < 1e-9
    few = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id long, x double")
    assert tuple(stats.shapiro_francia(few, "id", "x").first()) == (2, None, None, None)


def test_class_weights_of_many_classes(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") >= 10, F.col("id") % 3000).alias("y"), F.lit(7.0).alias("weight"))
    rows = split.class_weights(df, "y").collect()
    n = Counter(r["y"] for r in rows)
    assert len(rows) == 6000 and n[None] == 10 and len(n) == 3001
    assert all(r["weight"] == 6000 / (3001 * n[r["y"]]) for r in rows)
    assert {r["weight"] for r in split.class_weights(df, "y", {5: 2}).where("y = 5 OR y IS NULL").collect()} == {1.0, 2.0}


def test_spread_grows_with_the_rows(spark, monkeypatch):
    """A table of many rows gets more partitions than cores, and keeps its rows."""
    from larkspur import session

    monkeypatch.setattr(session, "SPREAD_ROWS", 100)
    out = session.spread(spark.range(0, 3000, 1, 2), "id")
    assert out.rdd.getNumPartitions() == 30 and out.distinct().count() == 3000
