"""Models: gradients, training progress, forest scoring by brute force, SVM share."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from dayguard.operators import autoencoder as ae
from dayguard.operators import iforest, ocsvm

COLS = [f"f{i}" for i in range(6)]


def _frame(spark, x, keys=True):
    pdf = pd.DataFrame(x, columns=COLS)
    pdf.insert(0, "CUSTOMER_ID", np.arange(len(x), dtype=np.int64) + 1)
    pdf.insert(1, "GA_SESSIONS_DATE", pd.Timestamp("2024-01-10").date())
    return spark.createDataFrame(pdf)


def test_autoencoder_gradients_match_finite_differences():
    dims = (6, 4, 2, 4, 6)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(7, 6))
    params = ae.init_params(dims, seed=1)
    loss, grads = ae._grads(params, dims, x)
    eps = 1e-6
    for k in (0, 1, 4, 7):
        p = [q.copy() for q in params]
        idx = tuple(0 for _ in p[k].shape)
        p[k][idx] += eps
        lp = float(np.mean((ae.forward(p, dims, x)[0] - x) ** 2))
        p[k][idx] -= 2 * eps
        lm = float(np.mean((ae.forward(p, dims, x)[0] - x) ** 2))
        assert abs((lp - lm) / (2 * eps) - grads[k][idx]) < 1e-6


def test_autoencoder_training_reduces_validation_loss(spark):
    rng = np.random.default_rng(5)
    z = rng.normal(size=(600, 2))
    x = np.c_[z, z @ rng.normal(size=(2, 4))]
    df = _frame(spark, x)
    tr = df.where(F.col("CUSTOMER_ID") % 10 != 0)
    va = df.where(F.col("CUSTOMER_ID") % 10 == 0)
    res = ae.train(tr, va, (6, 4, 2, 4, 6), epochs=15, batch=64, lr=0.01, cols=COLS)
    vals = [h[2] for h in res.history]
    assert vals[-1] < vals[0] * 0.8
    scored = df.select(ae.score_column(res.params, res.dims, COLS).alias("s")).toPandas()
    assert np.allclose(scored.s, ae.row_loss(res.params, res.dims, x))


def _path_length(nodes, x, n):
    """Recursive descent of one tree (brute force)."""
    by_id = {r.node: r for r in nodes.itertuples()}
    node, depth = by_id[0], 0
    while node.feature >= 0:
        node = by_id[node.left] if x[node.feature] <= node.threshold else by_id[node.right]
        depth += 1
    return depth + float(iforest.c_factor(node.size))


def test_isolation_forest_scores_match_bruteforce(spark):
    rng = np.random.default_rng(2)
    x = np.r_[rng.normal(size=(300, 6)), rng.normal(size=(5, 6)) + 6]
    df = _frame(spark, x)
    forest, nodes = iforest.fit(df, n_trees=20, max_samples=64, contamination=0.05, cols=COLS)
    pdf = nodes.toPandas()
    got = df.select(iforest.score_column(forest, COLS).alias("s")).toPandas().s.to_numpy()
    for i in (0, 17, 301):
        h = np.mean([_path_length(g, x[i], 64) for _, g in pdf.groupby("tree")])
        assert np.isclose(got[i], 2 ** (-h / iforest.c_factor(64)))
    assert got[300:].min() > np.median(got[:300])        # injected outliers isolate early
    pred = df.select(iforest.predict_column(forest, COLS).alias("p")).toPandas().p
    assert abs((pred == -1).mean() - 0.05) < 0.02
    # each tree saw exactly max_samples distinct rows
    assert set(pdf[pdf.node == 0]["size"]) == {64}


def test_one_class_svm_outlier_share_and_outliers(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 6))
    df = _frame(spark, x)
    m = ocsvm.fit(df, nu=0.1, gamma=0.1, n_components=64, epochs=3, cols=COLS)
    pred = df.select(ocsvm.predict_column(m, COLS).alias("p")).toPandas().p
    assert abs((pred == -1).mean() - 0.1) < 0.02
    far = _frame(spark, rng.normal(size=(20, 6)) + 8)
    fp = far.select(ocsvm.predict_column(m, COLS).alias("p")).toPandas().p
    assert (fp == -1).mean() > 0.9


def test_autoencoder_weights_roundtrip(spark):
    params = ae.init_params(ae.SHAPE_SMALL, seed=7)
    back = ae.params_from_frame(ae.weights_frame(spark, params), ae.SHAPE_SMALL)
    assert all(np.array_equal(a, b) for a, b in zip(params, back))
    assert sum(p.size for p in params) == 1400
    assert sum(p.size for p in ae.init_params(ae.SHAPE_LARGE)) == 3039


def test_epoch_weights_are_the_weighted_average_of_the_partitions(spark):
    dims = (6, 4, 2, 4, 6)
    x = np.random.default_rng(8).normal(size=(203, 6))
    df = _frame(spark, x)
    tr, va = df.where(F.col("CUSTOMER_ID") % 10 != 0), df.where(F.col("CUSTOMER_ID") % 10 == 0)
    frame = ae.training_frame(tr, va, COLS, partitions=4)
    assert frame.rdd.getNumPartitions() == 4
    parts = [[r for r in p if not r["is_val"]] for p in frame.rdd.glom().collect()]
    assert sum(bool(p) for p in parts) == 4
    like = ae.init_params(dims, 42)
    flat = ae._flatten(like)
    want, n = np.zeros_like(flat), 0
    for pid, rows in enumerate(parts):
        xs = np.array([r["x"] for r in rows])
        p, m, v, t = flat, np.zeros_like(flat), np.zeros_like(flat), 0
        order = np.random.default_rng([42, 0, pid]).permutation(len(xs))
        for s in range(0, len(xs), 16):
            p, m, v, t, _ = ae.adam_step(p, m, v, t, xs[order[s:s + 16]], dims, like, 0.01)
        want, n = want + len(xs) * p, n + len(xs)
    got = ae.train(tr, va, dims, epochs=1, batch=16, lr=0.01, cols=COLS, frame=frame)
    assert np.allclose(ae._flatten(got.params), want / n)
    one = ae.train(tr, va, dims, epochs=12, batch=16, lr=0.01, cols=COLS, partitions=1)
    four = ae.train(tr, va, dims, epochs=12, batch=16, lr=0.01, cols=COLS, frame=frame)
    assert all(r.history[-1][2] < 0.97 * r.history[0][2] for r in (one, four))


def test_forest_and_weights_survive_the_shared_folder(spark, tmp_path):
    df = _frame(spark, np.random.default_rng(2).normal(size=(300, 6)))
    forest, nodes = iforest.fit(df, n_trees=10, max_samples=32, contamination=[0.1, 0.01], cols=COLS)
    back = iforest.load(spark, iforest.save(nodes, forest, str(tmp_path / "forest")))
    x = np.random.default_rng(3).normal(size=(50, 6))
    assert np.array_equal(iforest.anomaly_score(forest, x), iforest.anomaly_score(back, x)) and back.offsets == forest.offsets
    params = ae.init_params(ae.SHAPE_SMALL, seed=3)
    again = ae.load(spark, ae.save(spark, str(tmp_path / "w"), params), ae.SHAPE_SMALL)
    assert all(np.array_equal(a, b) for a, b in zip(params, again))


def test_leaf_boxes_score_like_the_descent(spark):
    nodes = iforest.fixed_forest(12, 32, len(COLS), seed=3)
    forest = iforest.forest_from_nodes(nodes, 32)
    x = np.random.default_rng(9).normal(size=(200, len(COLS)))
    x[0, :], x[1, 0] = nodes["threshold"].iloc[0], np.nan_to_num(np.inf)  # on a threshold; very large
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i long, " + ", ".join(f"{c} double" for c in COLS))
    got = iforest.score_by_boxes(df, iforest.leaf_boxes(nodes), 32, ["i"], COLS).orderBy("i").toPandas()["score"].to_numpy()
    assert np.allclose(got, iforest.anomaly_score(forest, x), atol=1e-12)
    by_tree = {}
    for t, leaf, path, *_ in iforest.leaf_boxes(nodes):
        by_tree.setdefault(t, set()).add(leaf)
    leaves = nodes[nodes["feature"] < 0].groupby("tree")["node"].agg(set).to_dict()
    assert by_tree == leaves


def test_bottom_rows_are_those_of_the_window_sampler(spark):
    x = np.random.default_rng(12).normal(size=(300, len(COLS)))
    df = _frame(spark, x)
    rows = lambda d: {(r["tree"], r["rn"]): tuple(r["x"]) for r in d.collect()}
    for m in (16, 400):  # the pool of the window sampler is the whole table
        want, n = iforest.sample_for_trees(df, 7, m, 42, COLS)
        got = [rows(iforest.bottom_rows(df.repartition(p), 7, m, 42, COLS)) for p in (1, 5)]
        assert got[0] == got[1] == rows(want) and len(got[0]) == 7 * n
