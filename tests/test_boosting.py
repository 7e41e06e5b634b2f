"""Softmax boosting against the same rounds in plain numpy."""

import numpy as np
import pytest

from larkspur.models import boosting


def plain(x, y, many, cuts, rounds, depth, rate, penalty, least):
    """Scores after `rounds`, and the trees' nodes, by going through all cuts of all nodes."""
    s, log = np.full((len(x), many), 0.5), []
    for _ in range(rounds):
        e = np.exp(s)
        p = e / e.sum(1, keepdims=True)
        step = np.zeros_like(s)
        for k in range(many):
            g, h = p[:, k] - (y == k), 2 * p[:, k] * (1 - p[:, k])

            def grow(rows, node, level, k=k, g=g, h=h):
                gt, ht = g[rows].sum(), h[rows].sum()
                best = None
                if level < depth:
                    for f in range(x.shape[1]):
                        for c in range(cuts.shape[1]):
                            left = rows[x[rows, f] <= cuts[f, c]]
                            gl, hl = g[left].sum(), h[left].sum()
                            gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
                            if hl >= least and ht - hl >= least and round(gain, 9) > (best[0] if best else 0):
                                best = round(gain, 9), f, cuts[f, c]
                if best is None:
                    step[rows, k] = -rate * gt / (ht + penalty)
                    return
                log.append((k, node, best[1], float(best[2])))
                down = x[rows, best[1]] <= best[2]
                grow(rows[down], 2 * node + 1, level + 1)
                grow(rows[~down], 2 * node + 2, level + 1)

            grow(np.arange(len(x)), 0, 0)
        s = s + step
        log.append(None)
    return s, log


def data(spark, n=150):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(n, 4)), 2)
    y = np.where(x[:, 0] + 0.4 * rng.normal(size=n) > 0.5, 2, np.where(x[:, 1] > 0, 1, 0))
    return spark.createDataFrame([(i, [float(a) for a in r], float(c) + 3) for i, (r, c) in enumerate(zip(x, y))], "id long, v array<double>, y double").repartition(4), x, y


@pytest.mark.parametrize("cut_every", [2, 10])
def test_first_three_rounds(spark, cut_every):
    df, x, y = data(spark)
    model = boosting.fit_boosting(df, "v", "y", rounds=3, depth=2, rate=0.3, bins=8, cut_every=cut_every)
    cuts = boosting.cut_points(df.select(boosting.F.col("v").alias("x")), 8)
    want, log = plain(x, y, 3, cuts, 3, 2, 0.3, 1.0, 1.0)
    got = [(k, n, int(r.feature[k, n]), float(r.threshold[k, n])) if n >= 0 else None for r in model.rounds for k, n in [(k, n) for k in range(3) for n in (0, 1, 2) if r.feature[k, n] >= 0] + [(0, -1)]]
    assert got == log and len(log) > 15
    assert np.allclose(model.scores(x), want, atol=1e-9)
    rows = model.transform(df).collect()
    p = {r["id"]: r["probability"] for r in rows}
    assert all(np.allclose(p[i], boosting.softmax(want[i: i + 1])[0], atol=1e-9) for i in range(len(x)))
    assert np.mean([r["prediction"] == y[r["id"]] + 3 for r in rows]) > 0.8


def test_loss_falls_and_one_class(spark):
    df, x, y = data(spark, 90)
    model = boosting.fit_boosting(df, "v", "y", rounds=4, depth=1, rate=0.5, bins=4)
    loss = []
    for n in range(5):
        s = boosting.Boosted(model.classes, 1, "v", model.rounds[:n]).scores(x)
        loss.append(-np.log(boosting.softmax(s)[np.arange(len(y)), y]).mean())
    assert loss == sorted(loss, reverse=True)
    one = boosting.fit_boosting(df.withColumn("y", boosting.F.lit(1.0)), "v", "y", rounds=1, depth=2)
    assert {r["prediction"] for r in one.transform(df).collect()} == {1.0}
    with pytest.raises(ValueError):
        boosting.fit_boosting(df.limit(0), "v", "y")


def test_bins_stand_for_values(spark):
    """Rows hold bins, found once before the rounds; trees send them where they send the values, NaN and equal cuts too."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(80, 3)), 1)
    x[5, 1], cuts = np.nan, np.sort(np.round(rng.normal(size=(3, 7)), 1), axis=1)
    df = spark.createDataFrame([([float(a) for a in r], 0, [0.5]) for r in x], "x array<double>, y int, s array<double>").coalesce(1)
    both = boosting._binned(df, cuts).toArrow()["x"].combine_chunks()
    route, sums = boosting._bins(both, 3)
    assert sums[5, 1] > 7 and route[5, 1] == 0
    feature, cut = rng.integers(-1, 3, size=(2, 7)), rng.integers(0, 7, size=(2, 7))
    tree = boosting.Round(feature, cuts[np.maximum(feature, 0), cut], rng.normal(size=(2, 7)), cut)
    assert np.array_equal(tree.at(route, 2, binned=True), tree.at(x, 2))
    assert np.array_equal(tree.scores(route, 2, binned=True), tree.scores(x, 2))
