"""The committee's members against one Newton iteration each, in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.models import committee

NAMES = ["a", "b", "c", "d"]


def data(spark, n=400):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 4)) * [1, 50, 0.1, 1] + [0, 1000, 0, 3]
    y = (x[:, 0] + (x[:, 1] - 1000) / 50 + rng.normal(size=n) > 0.8).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))], ["id", *NAMES, "y"]).repartition(5)
    keys = np.array([r[0] for r in df.select("id", F.xxhash64("id").alias("h")).orderBy("id").select("h").collect()])
    return df, x, y, keys


def newton(x, y, w, C):
    """Weights and intercept on plain columns; |w|^2 / 2 + C * weighted loss."""
    z = np.column_stack([x, np.ones(len(x))])
    mid, sd = np.append(x.mean(0), 0), np.append(x.std(0), 1)
    z = (z - mid) / sd
    pen, b = np.append(1 / sd[:-1] ** 2, 0), np.zeros(z.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ b))
        step = np.linalg.solve(C * z.T @ (z * (w * p * (1 - p))[:, None]) + np.diag(pen), C * z.T @ (w * (p - y)) + pen * b)
        b = b - step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    return b


def test_members_equal_single_fits(spark, monkeypatch):
    df, x, y, keys = data(spark)
    reads = []
    add = committee._sum_blobs
    monkeypatch.setattr(committee, "_sum_blobs", lambda *a: reads.append(1) or add(*a))
    model = committee.fit_committee(df, "id", NAMES, "y", df, n=6, rows=300, redraw=200, C_grid=[0.01, 1.0], folds=3, trees=5)
    assert len(reads) < 40  # as many as the slowest member's steps, not one run a member
    cost = np.where(y == 1, 0.9, 0.1)
    for i, (cols, coef) in enumerate(zip(model.columns, model.coefficients)):
        w = cost * committee.draws(keys, i, 300 / len(x), 200 / 300, 42)
        assert np.allclose(coef[: len(cols) + 1], newton(x[:, cols], y, w, model.C), atol=1e-6)
    part, last = committee.folds_of(keys, 3, 42), model.columns[-1]
    drawn = committee.draws(keys, 5, 300 / len(x), 200 / 300, 42)
    for C, score in model.scores:
        hit = []
        for f in range(3):
            b = newton(x[:, last], y, cost * drawn * (part != f), C)
            z = np.column_stack([(x[:, last] - x[:, last].mean(0)) / x[:, last].std(0), np.ones(len(x))])
            on = drawn * (part == f)
            hit.append((on @ ((z @ b > 0) == y)) / on.sum())
        assert score == pytest.approx(np.mean(hit), abs=1e-9)
    assert model.C == max(model.scores, key=lambda s: (s[1], -s[0]))[0]
    votes = {r["id"]: r["votes"] for r in model.votes(df).collect()}
    want = np.column_stack([committee._design(x, c, model.mean, model.scale) @ w[: len(c) + 1] > 0 for c, w in zip(model.columns, model.coefficients)]).astype(float)
    assert [votes[i] for i in range(len(x))] == want.tolist()
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert [got[i] for i in range(len(x))] == model.meta.votes(want).mean(1).argmax(1).tolist()


def test_draws_have_the_asked_size():
    keys = np.arange(200_000) * 7919
    d = committee.draws(keys, 3, 0.5, 2 / 3, 1)
    assert abs(d.sum() / len(keys) - 0.5 * (1 + 2 / 3)) < 0.01 and (d >= 0).all()
    assert abs(committee.poisson(committee.unit(1, keys), 5.0).mean() - 5) < 0.05


def test_no_rows(spark):
    df, *_ = data(spark, 20)
    with pytest.raises(ValueError):
        committee.fit_committee(df.limit(0), "id", NAMES, "y", df)
