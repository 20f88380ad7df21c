"""Dual one-class SVM against a quadratic programme solved pair by pair."""

import datetime as dt

import numpy as np
import pytest

from dayguard.operators import ocsvm_dual as O
from dayguard.schema import FEATURES, KEY_COLS

N = 60


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(N, len(FEATURES))) * 0.6
    x[:4] += 3
    x[10] = x[11]  # a repeated row
    schema = f"{KEY_COLS[0]} long, {KEY_COLS[1]} date, " + ", ".join(f"{c} double" for c in FEATURES)
    return x, spark.createDataFrame([(i, dt.date(2024, 1, 1), *map(float, r)) for i, r in enumerate(x)], schema).repartition(3)


def programme(k, nu):
    """min 1/2 a'Ka, 0 <= a <= 1/(nu n), sum a = 1, by the most violating pair."""
    n, top = len(k), 1.0 / max(1.0, nu * len(k))
    a = np.full(n, 1.0 / n)
    for _ in range(200_000):
        g = k @ a
        up, down = np.where(a < top - 1e-15, g, np.inf).argmin(), np.where(a > 1e-15, g, -np.inf).argmax()
        if g[down] - g[up] < 1e-11:
            break
        step = (g[down] - g[up]) / max(k[up, up] + k[down, down] - 2 * k[up, down], 1e-15)
        step = min(step, top - a[up], a[down])
        a[up] += step
        a[down] -= step
    return a


@pytest.mark.parametrize("nu", [0.3, 0.1, 0.001])
def test_equals_the_quadratic_programme(spark, data, nu):
    x, df = data
    k = O.rbf(x, x, 0.1)
    a = programme(k, nu)
    (m,) = O.fit(df, [nu], gamma=0.1, landmarks=N, tolerance=2e-6, max_rounds=300)
    assert m.gap <= 2e-6 * float(m.w @ m.w)
    assert abs(float(m.w @ m.w) - a @ k @ a) < 1e-6
    got = {r[0]: r[1] for r in df.select(KEY_COLS[0], (O.decision_column(m) + m.rho).alias("d")).collect()}
    assert np.abs(np.array([got[i] for i in range(N)]) - k @ a).max() < 1e-3
    share = sum(d < m.rho for d in got.values()) / N
    assert abs(share - nu) <= 1 / N


def test_gap_bounds_the_distance_to_the_optimum(spark, data):
    x, df = data
    k = O.rbf(x, x, 0.1)
    best = 0.5 * (lambda a: a @ k @ a)(programme(k, 0.2))
    for rounds in (1, 3, 10):
        (m,) = O.fit(df, [0.2], gamma=0.1, landmarks=N, tolerance=0.0, max_rounds=rounds)
        assert 0.5 * float(m.w @ m.w) - best <= m.gap + 1e-12


def test_several_nus_share_the_rounds_and_few_landmarks(spark, data):
    _, df = data
    models = O.fit(df, [0.1, 0.3], gamma=0.1, landmarks=12)
    assert [m.nu for m in models] == [0.1, 0.3] and all(m.gap <= 1e-4 * float(m.w @ m.w) for m in models)
    assert all(len(m.landmarks) == 12 for m in models)


def test_empty(spark, data):
    assert O.fit(data[1].where("false"), [0.1]) == []
