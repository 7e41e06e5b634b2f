"""The kernel map against the kernel, and the classifier against an exact dual solution."""

import numpy as np
import pytest

from larkspur.models import kernel


def rings(n, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    r, a = np.where(y == 1, 2.5, 1.0) + 0.25 * rng.normal(size=n), rng.uniform(0, 2 * np.pi, n)
    return np.column_stack([r * np.cos(a), r * np.sin(a)]), y


def frame(spark, x, y):
    return spark.createDataFrame([(i, [float(a) for a in r], float(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, v array<double>, y double")


def test_kernel_error_falls_with_the_draws():
    x = np.random.default_rng(1).normal(size=(80, 5))
    error = [kernel.kernel_error(kernel.FourierMap(5, 0.2, d), x) for d in (64, 1024, 16_384)]
    assert error[1][0] < 0.03 and error[1][1] < 0.15
    assert error[0][0] > 2 * error[1][0] > 4 * error[2][0]


def dual(k, y, C, rounds=400):
    """Box-bound multipliers by coordinate steps; the kernel plus one holds the intercept."""
    s, k = 2.0 * y - 1, k + 1
    a = np.zeros(len(y))
    for _ in range(rounds):
        for i in range(len(y)):
            a[i] = min(C, max(0.0, a[i] + (1 - s[i] * (k[i] @ (a * s))) / k[i, i]))
    return a * s


def test_agrees_with_the_exact_kernel(spark):
    """Of 300 unseen points on two rings, which no line parts, at least 97 in a hundred are judged as by the exact kernel."""
    x, y = rings(160, 2)
    t, truth = rings(300, 3)
    model = kernel.fit_kernel_svc(frame(spark, x, y), "v", "y", C=1.0, gamma=0.5)
    got = {r["id"]: r["prediction"] for r in model.transform(frame(spark, t, truth)).collect()}
    got = np.array([got[i] for i in range(len(t))])
    radial = lambda a, b: np.exp(-0.5 * ((a[:, None] - b[None]) ** 2).sum(2))
    exact = (radial(t, x) + 1) @ dual(radial(x, x), y, 1.0) > 0
    assert (got == exact).mean() >= 0.97
    assert (got == truth).mean() > 0.95


def test_default_gamma_and_no_rows(spark):
    x, y = rings(50, 4)
    df = frame(spark, x, y)
    assert kernel.scale_gamma(df, "v") == pytest.approx(1 / (2 * x.var()))
    with pytest.raises(ValueError):
        kernel.fit_kernel_svc(df.limit(0), "v", "y")
