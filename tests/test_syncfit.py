"""Synchronous training against a plain loop over the same shuffle."""

import datetime as dt

import numpy as np
import pytest

from dayguard.operators import autoencoder as ae
from dayguard.operators import syncfit as S
from dayguard.schema import FEATURES, KEY_COLS

DIMS = ae.SHAPE_SMALL
N = 137


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(N, len(FEATURES)))
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i % 20) for i in range(N)]
    rows = [(i // 20, d, *map(float, r)) for i, (d, r) in enumerate(zip(days, x))]
    schema = f"{KEY_COLS[0]} long, {KEY_COLS[1]} date, " + ", ".join(f"{c} double" for c in FEATURES)
    return x, spark.createDataFrame(rows, schema)


def plain(x, epochs, batch, lr=1e-3, seed=42):
    like = ae.init_params(DIMS)
    p = ae._flatten(ae.init_params(DIMS, seed))
    m, v, t = np.zeros_like(p), np.zeros_like(p), 0
    for e in range(epochs):
        order = np.argsort(S.permuted(np.arange(len(x)), len(x), seed, e))
        for s in range(0, len(x), batch):
            p, m, v, t, _ = ae.adam_step(p, m, v, t, x[order[s:s + batch]], DIMS, like, lr)
    return p


def test_permutation():
    for n in (1, 2, 3, 17, 64, 1000):
        a, b = S.permuted(np.arange(n), n, 1, 0), S.permuted(np.arange(n), n, 1, 1)
        assert sorted(a) == list(range(n)) == sorted(b)
    assert (a != b).any()


def test_weights_do_not_depend_on_partitions(spark, data):
    x, df = data
    want = plain(x, 2, 16)
    for partitions, run_rows in ((1, 1000), (3, 48), (5, 16)):
        rows = S.placed(df.repartition(partitions + 2), partitions=partitions)
        assert [r["at"] for r in rows.orderBy("at").collect()] == list(range(N))
        p = ae._flatten(ae.init_params(DIMS, 42))
        m, v, t = np.zeros_like(p), np.zeros_like(p), 0
        for e in range(2):
            p, m, v, t, _ = S._epoch(rows, N, DIMS, p, m, v, t, 1e-3, 16, 42, e, run_rows)
        assert t == 2 * -(-N // 16) and np.array_equal(p, want)


def test_steps_larger_than_a_task_sum_gradients(spark, data):
    x, df = data
    rows = S.placed(df, partitions=3)
    p = ae._flatten(ae.init_params(DIMS, 42))
    p, *_ = S._epoch(rows, N, DIMS, p, np.zeros_like(p), np.zeros_like(p), 0, 1e-3, 50, 42, 0, 20)
    assert np.abs(p - plain(x, 1, 50)).max() < 1e-9


def test_full_batch_step(spark, data):
    x, df = data
    params = ae.init_params(DIMS, 42)
    g, w = S.full_batch_step(df.repartition(4), DIMS, params)
    _, want = ae._grads(params, DIMS, x)
    assert max(np.abs(a - b).max() for a, b in zip(g, want)) < 1e-12
    p, *_ = ae.adam_step(ae._flatten(params), 0.0, 0.0, 0, x, DIMS, params, 1e-3)
    assert np.abs(ae._flatten(w) - p).max() < 1e-9


def test_training_lowers_the_loss_and_keeps_the_best_epoch(spark, data):
    _, df = data
    res = S.train(df, df.limit(30), DIMS, epochs=4, batch=32, lr=5e-3, partitions=2)
    losses = [h[2] for h in res.history]
    assert len(losses) == 4 and losses[-1] < losses[0] and res.best_epoch == 1 + int(np.argmin(losses))
    assert S.train(df.where("false"), df.where("false"), DIMS, epochs=2).history == []
