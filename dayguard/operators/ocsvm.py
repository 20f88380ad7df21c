"""One-class SVM with an RBF kernel, approximated for scale.

The exact kernel solver is quadratic in the rows and single-machine.  Here the
kernel exp(-gamma ||x - y||^2) is approximated by random Fourier features
(Rahimi & Recht 2007): z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma),
b ~ U(0, 2 pi); the one-class objective (Schoelkopf et al. 2001)

    min 1/2 |w|^2 - rho + 1/(nu n) sum_i max(0, rho - w.z(x_i))

is then linear in z and is solved by minibatch subgradient steps inside each
partition, averaged by row count (sums by Spark) after every epoch (start: the
kernel mean, the nu = 1 solution).  Finally rho is set to the exact nu-quantile
of w.z over the training rows, so the training outlier share is nu.
Labels will not equal an exact solver's row by row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.functions.quantile import exact_quantile
from dayguard.operators.autoencoder import training_frame
from dayguard.schema import FEATURES

N_COMPONENTS = 128
BLOCK = 8192  # rows whose Fourier features are held at once


def fourier_map(dim: int, gamma: float, n_components: int = N_COMPONENTS,
                seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, dim))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    return w, b


def fourier_features(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    return math.sqrt(2.0 / w.shape[0]) * np.cos(x @ w.T + b)


@dataclass
class OneClassModel:
    w_map: np.ndarray
    b_map: np.ndarray
    coef: np.ndarray
    rho: float
    nu: float
    gamma: float


def decision_column(m: OneClassModel, cols: list[str] = FEATURES) -> Column:
    """w.z(x) - rho: negative = outlier."""
    wm, bm, coef, rho = m.w_map.copy(), m.b_map.copy(), m.coef.copy(), float(m.rho)

    @F.pandas_udf(T.DoubleType())
    def _d(x: pd.DataFrame) -> pd.Series:
        z = fourier_features(x.to_numpy(dtype=np.float64), wm, bm)
        return pd.Series(z @ coef - rho)

    return _d(F.struct(*[F.col(c).cast("double") for c in cols]))


def predict_column(m: OneClassModel, cols: list[str] = FEATURES) -> Column:
    return F.when(decision_column(m, cols) < 0, -1).otherwise(1)


def _partial_fn(wm, bm, states, lr, batch, seed, epoch, mode):
    """``states``: (nu, coefficients, rho) of every model; all are trained in one pass."""
    def run(it):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        frames = [f for f in it if len(f)]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True)
        pdf = pdf[~pdf["is_val"].to_numpy(dtype=bool)]
        if not len(pdf):
            return
        x, w, b = np.stack(pdf["x"].to_numpy()), np.array(wm), np.array(bm)
        n = len(x)
        if mode == "mean":
            total = sum(fourier_features(x[s:s + BLOCK], w, b).sum(axis=0) for s in range(0, n, BLOCK))
            yield _weighted(0, n, total / n, 0.0)
            return
        now = [(nu, np.array(c), float(r)) for nu, c, r in states]
        order = np.random.default_rng([seed, epoch, pid]).permutation(n)
        for s in range(0, n, batch):
            zb = fourier_features(x[order[s:s + batch]], w, b)
            for i, (nu, c, r) in enumerate(now):
                viol = (zb @ c) < r
                gc = c - zb[viol].sum(axis=0) / (nu * len(zb))
                gr = -1.0 + viol.sum() / (nu * len(zb))
                now[i] = nu, c - lr * gc, r - lr * gr
        for i, (_, c, r) in enumerate(now):
            yield _weighted(i, n, c, r)
    return run


def _weighted(i: int, n: int, coef: np.ndarray, rho: float) -> pd.DataFrame:
    """Model i: (-1, rows), (0, rho x rows), (1 + j, coefficient j x rows)."""
    return pd.DataFrame({"i": i, "k": range(-1, len(coef) + 1), "v": np.concatenate(([n, n * rho], n * coef))})


def fit_all(train: DataFrame, nus: list[float], gamma: float = 0.1, n_components: int = N_COMPONENTS,
            epochs: int = 5, batch: int = 2048, lr: float = 0.05, seed: int = 42,
            cols: list[str] = FEATURES, partitions: int | None = None, frame: DataFrame | None = None) -> list[OneClassModel]:
    """One model per nu from the same passes over the rows. ``partitions`` and ``batch`` are
    part of the models' definition (averaging after every epoch)."""
    frame = frame if frame is not None else training_frame(train, train.where(F.lit(False)), cols, partitions)
    wm, bm = fourier_map(len(cols), gamma, n_components, seed)

    def job(states, e, mode):
        fn = _partial_fn(wm.tolist(), bm.tolist(), [(nu, c.tolist(), r) for nu, c, r in states], lr / math.sqrt(e + 1), batch, seed, e, mode)
        got = frame.mapInPandas(fn, "i int, k int, v double").groupBy("i", "k").agg(F.sum("v").alias("v")).toPandas().set_index(["i", "k"])["v"]
        out = []
        for i in range(1 if mode == "mean" else len(states)):
            n = max(float(got.get((i, -1), 0.0)), 1.0)
            out.append((np.array([got.get((i, j + 1), 0.0) for j in range(n_components)]) / n, float(got.get((i, 0), 0.0)) / n))
        return out

    # the kernel mean (the nu = 1 solution); with epochs = 0 it is the model
    (mean, rho), = job([], 0, "mean")
    states = [(nu, mean, rho) for nu in nus]
    for e in range(epochs):
        states = [(nu, c, r) for nu, (c, r) in zip(nus, job(states, e, "sgd"))]
    out = []
    for nu, coef, _ in states:
        model = OneClassModel(wm, bm, coef, 0.0, nu, gamma)
        model.rho = exact_quantile(train.select(decision_column(model, cols).alias("d")), "d", nu)
        out.append(model)
    return out


def fit(train: DataFrame, nu: float, **kwargs) -> OneClassModel:
    """One model; see :func:`fit_all`."""
    return fit_all(train, [nu], **kwargs)[0]
