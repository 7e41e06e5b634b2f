import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import quality
from larkspur.llm.queries import QUERIES


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op8_quality"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    out = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(out) > 60 and np.mean([p == t for p, t in out]) > 0.95
    assert np.mean([p for p, t in out if t == 1]) > 0.97


def in_memory(x, p):
    return lambda f, *args: f(x, p, *args)


def test_risk_of_positives_and_unlabelled_only():
    """Half of the unlabelled rows are negatives; no label names them, nor most of the positives."""
    rng = np.random.default_rng(1)
    n = quality.N_FEATURES
    pos, neg = rng.normal(1.5, 1, (900, n)), rng.normal(-1.5, 1, (900, n))
    m = quality.least_risk(in_memory(np.concatenate([pos[:600], neg[:600]]), np.arange(1200) < 300), 0.5, n)
    g = lambda x: (x - m.mean) / m.scale @ m.weight + m.bias
    assert (g(neg[600:]) < 0).mean() > 0.97 and (g(pos[600:]) > 0).mean() > 0.9
    assert quality.least_risk(in_memory(pos, np.zeros(900)), 0.5, n) is None


def test_negative_part_stays_above_zero():
    """With far too large a prior the risk on the negatives would go below zero."""
    rng = np.random.default_rng(2)
    n, x, p = 5, np.concatenate([rng.normal(1, 1, (300, 5)), rng.normal(-1, 1, (700, 5))]), np.arange(1000) < 200
    m = quality.least_risk(in_memory(x, p), 0.8, n)
    loss = np.logaddexp(0, (x - m.mean) / m.scale @ m.weight + m.bias)
    assert abs(loss.mean() - 0.8 * loss[p].mean()) < 1e-3


def test_least_risk_equals_plain_descent():
    """Where the border does not bind: accelerated gradient steps over the rows, without Newton steps or sums."""
    rng = np.random.default_rng(3)
    x, q = np.concatenate([rng.normal(0.5, 1, (500, 4)), rng.normal(-0.5, 1, (500, 4))]), 0.4
    p = np.arange(1000) < 250
    m = quality.least_risk(in_memory(x, p), q, 4, tol=0.0)
    z = np.hstack([(x - x.mean(0)) / (x.std(0) + 0.01), np.ones((1000, 1))])
    w = far = np.zeros(5)
    for k in range(20_000):
        new = far - 0.5 * (z.T @ (1 / (1 + np.exp(-z @ far))) / 1000 - q * z[p].mean(0) + quality.DECAY * far)
        w, far = new, new + k / (k + 3) * (new - w)
    loss = np.logaddexp(0, z @ w)
    assert loss.mean() - q * loss[p].mean() > 0
    assert np.append(m.weight, m.bias) == pytest.approx(w, abs=1e-4)


def test_fit_reads_every_training_row(spark, sf):
    """The fit of the query equals one on plain arrays of all training rows; no row is left out."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    told = {r["doc_id"]: r["quality"] for r in labels.collect() if not out(r["doc_id"])}
    rows = [(told.get(r["doc_id"]) == 1, (r["text"] or "").encode()) for r in docs.collect() if not out(r["doc_id"])]
    p, x = np.array([r[0] for r in rows]), np.array([quality.features(r[1]) for r in rows], np.float32).astype(float)
    want = quality.least_risk(in_memory(x, p), np.mean(list(told.values())), quality.N_FEATURES)
    got = quality.fit(docs.repartition(3), labels)
    texts = [r[1] for r in rows]
    assert got.mean == pytest.approx(x.mean(0), abs=1e-9) and abs(got.score(texts) - want.score(texts)).max() < 1e-3


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (2, "", 5.0), (None, "Good text. " * 9, 5.0), (3, "Good text. " * 30_000, 5.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 1), (None, 1), (77, 1)], "doc_id long, quality int")
    rows = quality.classify(docs, quality.fit(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert len({r["score"] for r in rows}) > 1  # rows without an id are unlabelled rows, too
    assert quality.classify(docs.limit(0), quality.fit(docs.limit(0), labels)).count() == 0
    many = spark.range(300).select(F.lit(2).cast("long").alias("doc_id"), F.concat(F.lit("Some text "), "id").alias("text"))
    assert np.isfinite(quality.fit(many, labels, fit_rows=1).weight).all()  # one id on every row
    none = quality.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality.classify(docs, none).collect()} == {0.5}


def test_features_are_bounded():
    for t in (b"", b" ", b"\n\n", b"A" * 10**6, b"\xc3\xa9!!" * 100, bytes(range(128))):
        f = quality.features(t)
        assert f.shape == (quality.N_FEATURES,) and np.isfinite(f).all() and (abs(f) <= 1).all()
