"""Corrections by a stream: late and repeated ones, any order of arrival, and the refitted model."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

from larkspur.models import bayes
from larkspur.session import scratch_path
from larkspur.streaming import refit, scoring

DDL = "k long, y string, at timestamp"
START = datetime(2024, 1, 1)


def send(spark, rows, path):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def paths(spark):
    return [scratch_path(spark, f"refit-{n}") for n in ("in", "out", "state")]


def run(spark, arrived, out, state, delay):
    schema = spark.createDataFrame([], DDL).schema
    refit.follow_corrections(spark, arrived, schema, out, state, "k", "y", "at", delay, files_per_trigger=2).awaitTermination()


def test_any_order_of_arrival_gives_the_batch_fit(spark):
    rng = random.Random(4)
    words = {k: [rng.choice("abcdefgh") for _ in range(rng.randrange(6))] for k in range(40)}
    train = spark.createDataFrame([(k, rng.choice("xy")) for k in range(25)] + [(25, None)], "k long, y string")
    terms = spark.createDataFrame([(k, t, n) for k, ws in words.items() for t, n in Counter(ws).items()], "k long, term string, tf long")
    fixes = [(rng.randrange(40), rng.choice("xyz"), START + timedelta(hours=rng.randrange(5))) for _ in range(120)]
    fixes += [(None, "x", START), (3, None, START), (3, "x", None)]
    good = spark.createDataFrame([f for f in fixes if None not in f], DDL)
    latest = good.selectExpr("k", "y", "struct(at, y) AS at")
    merged = scoring.merge_corrections(train, latest, "k", "y", "at").where("y is not null")
    want = bayes.fit_multinomial_nb(terms, merged, "k", "y", alpha=0.5)
    for _ in range(2):
        rng.shuffle(fixes)
        arrived, out, state = paths(spark)
        for i in range(0, len(fixes), 41):  # the stream stops and goes on between the lots
            send(spark, fixes[i : i + 41], arrived)
            run(spark, arrived, out, state, "30 days")
        before = refit.statistics(terms, refit.labelled(train, "k", "y"), "k")
        change = refit.moved(spark.read.parquet(out), train, "k", "y")
        got = refit.model(refit.refit(before, terms, change, "k"), alpha=0.5)
        assert (got.classes, got.sizes) == (want.classes, want.sizes)
        rows = {(r["term"], r["class"]): (r["total"], round(r["log_prob"], 12)) for r in got.table.collect()}
        assert rows == {(r["term"], r["class"]): (r["total"], round(r["log_prob"], 12)) for r in want.table.collect()}


def test_late_corrections_are_dropped(spark):
    arrived, out, state = paths(spark)
    send(spark, [(1, "x", START + timedelta(days=9)), (2, "x", START + timedelta(days=9))], arrived)
    run(spark, arrived, out, state, "2 days")
    send(spark, [(1, "y", START + timedelta(days=8)), (2, "y", START + timedelta(days=9)), (3, "y", START), (4, "y", START + timedelta(days=8))], arrived)
    run(spark, arrived, out, state, "2 days")
    got = {(r["key"], r["was"], r["label"], r["first"]) for r in spark.read.parquet(out).collect()}
    # 1: older than what is held; 2: a tie, the larger label; 3: behind the watermark; 4: late, but within the delay
    assert got == {(1, None, "x", True), (2, None, "x", True), (2, "x", "y", False), (4, None, "y", True)}


def test_state_and_calls_do_not_grow_with_the_keys(spark, monkeypatch):
    """Many keys of one part of the state: each keeps its own label, over two starts of the stream."""
    monkeypatch.setattr(refit, "BUCKETS", 3)
    arrived, out, state = paths(spark)
    ddl, at = "k string, y int, at timestamp", [START + timedelta(hours=h) for h in range(3)]
    for lot in range(2):
        rows = [(f"k{k}", (k + lot) % 5, at[1] if lot == 0 or k % 2 else at[0]) for k in range(100 * lot, 200 + 100 * lot)]
        rows += [(k, 9, at[0]) for k, _, t in rows if t == at[1]]  # older than the others of this lot
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(arrived)
        query = refit.follow_corrections(spark, arrived, spark.createDataFrame([], ddl).schema, out, state, "k", "y", "at", "30 days")
        query.awaitTermination()
        assert sum(s["numRowsTotal"] for s in query.recentProgress[-1]["stateOperators"]) <= 3
    want = {(f"k{k}", None, k % 5, True) for k in range(200)}
    # of the keys of both lots, odd ones have a label of the same time, which holds if larger
    want |= {(f"k{k}", k % 5, (k + 1) % 5, False) for k in range(100, 200) if k % 2 and (k + 1) % 5 > k % 5}
    want |= {(f"k{k}", None, (k + 1) % 5, True) for k in range(200, 300)}
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=str) == sorted(want, key=str)


def test_statistics_by_hand(spark):
    train = spark.createDataFrame([(1, 0), (2, 1)], "k long, y int")
    terms = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (3, "b", 4)], "k long, term string, tf long")
    changes = spark.createDataFrame([(1, None, 1, True), (1, 1, 0, False), (2, None, 0, True), (3, None, 1, True)], "key long, was int, label int, first boolean")
    change = refit.moved(changes, train, "k", "y")
    assert {tuple(r) for r in change.collect()} == {(2, 1, -1), (2, 0, 1), (3, 1, 1)}  # 1 is back where it was
    stats = refit.refit(refit.statistics(terms, refit.labelled(train, "k", "y"), "k"), terms, change, "k")
    assert {tuple(r) for r in stats.collect()} == {(None, 0, 2), (None, 1, 1), ("a", 0, 3), ("b", 1, 4)}
    m = refit.model(stats)
    assert m.sizes == [2, 1]
    assert {(r["term"], r["class"]): round(math.exp(r["log_prob"]), 9) for r in m.table.collect()}["b", 1] == round(5 / 6, 9)
