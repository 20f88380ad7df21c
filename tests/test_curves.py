"""Curves against a brute-force implementation of the textbook definitions."""

import numpy as np
import pytest

from dayguard.operators import curves


def _brute(y, s):
    thr = np.sort(np.unique(s))[::-1]
    P, N = y.sum(), (1 - y).sum()
    tp = np.array([((s >= t) & (y == 1)).sum() for t in thr])
    fp = np.array([((s >= t) & (y == 0)).sum() for t in thr])
    fpr, tpr = fp / N, tp / P
    auc = np.trapezoid(np.r_[0, tpr], np.r_[0, fpr])
    prec = tp / (tp + fp)
    ap = np.sum(np.diff(np.r_[0, tp / P]) * prec)
    return thr, fpr, tpr, auc, prec, ap


def _frame(spark, y, s):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")


@pytest.mark.parametrize("n,ties", [(200, False), (300, True)])
def test_roc_auc_ap_match_bruteforce(spark, n, ties):
    rng = np.random.default_rng(n)
    y = (rng.random(n) < 0.3).astype(int)
    s = rng.normal(size=n) + y
    if ties:
        s = np.round(s, 1)
    cum = curves.cumulative_counts(_frame(spark, y, s), n_buckets=5)
    thr, fpr, tpr, auc, prec, ap = _brute(y, s)
    roc = curves.roc_curve(cum).toPandas().sort_values("threshold", ascending=False)
    assert np.allclose(roc.threshold, thr) and np.allclose(roc.fpr, fpr) and np.allclose(roc.tpr, tpr)
    assert np.isclose(curves.auc(cum).first()[0], auc)
    assert np.isclose(curves.average_precision(cum).first()[0], ap)
    pr = curves.pr_curve(cum).toPandas()
    assert pr.threshold.isna().sum() == 1
    end = pr[pr.threshold.isna()].iloc[0]
    assert end.precision == 1.0 and end.recall == 0.0


def test_auc_tie_case_and_symmetry(spark):
    y = np.array([0, 0, 1, 1, 0])
    s = np.array([0.1, 0.5, 0.5, 0.9, 0.3])
    cum = curves.cumulative_counts(_frame(spark, y, s), n_buckets=3)
    a = curves.auc(cum).first()[0]
    cum2 = curves.cumulative_counts(_frame(spark, y, -s), n_buckets=3)
    assert np.isclose(a + curves.auc(cum2).first()[0], 1.0)
    # rank-sum form of the AUC (ties count one half)
    pos, neg = s[y == 1], s[y == 0]
    rs = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert np.isclose(a, rs)


def test_f1_null_where_zero(spark):
    y = np.array([0, 0, 1])
    s = np.array([0.9, 0.8, 0.1])
    f1 = curves.f1_curve(curves.cumulative_counts(_frame(spark, y, s), n_buckets=2)).toPandas()
    top = f1.sort_values("threshold").iloc[-1]
    assert top.f1 is None or np.isnan(top.f1)


def _sk_drop(fps, tps):
    """The usual library's collinear-point rule on cumulative counts."""
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    return np.flatnonzero(keep)


@pytest.mark.parametrize("seed", [1, 2])
def test_roc_drop_intermediate_matches_rule(spark, seed):
    rng = np.random.default_rng(seed)
    n = 400
    y = (rng.random(n) < 0.4).astype(int)
    s = np.round(rng.normal(size=n) + y, 1)
    thr = np.sort(np.unique(s))[::-1]
    tp = np.array([((s >= t) & (y == 1)).sum() for t in thr])
    fp = np.array([((s >= t) & (y == 0)).sum() for t in thr])
    idx = _sk_drop(fp, tp)
    cum = curves.cumulative_counts(_frame(spark, y, s), n_buckets=6)
    got = curves.roc_curve(cum, drop_intermediate=True).toPandas()
    pts = got[got.threshold.notna()].sort_values("threshold", ascending=False)
    assert np.allclose(pts.threshold, thr[idx])
    assert np.allclose(pts.fpr, fp[idx] / fp[-1]) and np.allclose(pts.tpr, tp[idx] / tp[-1])
    start = got[got.threshold.isna()].iloc[0]
    assert start.fpr == 0.0 and start.tpr == 0.0
