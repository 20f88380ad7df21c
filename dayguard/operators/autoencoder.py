"""Autoencoder anomaly model: fully connected, ReLU between layers, linear
code and output; the anomaly score is the row's mean squared reconstruction
error.

Training runs as Spark jobs: per epoch every partition takes the broadcast
weights and Adam state, runs shuffled minibatch Adam over its own rows in
numpy, and hands on its weights times its row count; Spark sums them by
parameter (parameter averaging), so the driver gets one row per parameter
whatever the number of partitions.  Validation loss, plateau learning-rate decay and the
best-epoch weights are handled on the driver.  Scoring is a pandas UDF over
Arrow batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.schema import FEATURES, KEY_COLS
from dayguard.session import cut_lineage

# fixed values: layer widths of the two published shapes
SHAPE_SMALL = (36, 15, 7, 2, 7, 15, 36)
SHAPE_LARGE = (36, 26, 15, 7, 3, 7, 15, 26, 36)
CODE_LAYER = {SHAPE_SMALL: 3, SHAPE_LARGE: 4}


def init_params(dims: tuple, seed: int = 42) -> list[np.ndarray]:
    """[W1, b1, W2, b2, ...], W of shape (out, in), U(-1/sqrt(in), 1/sqrt(in))."""
    rng = np.random.default_rng(seed)
    params = []
    for fan_in, fan_out in zip(dims[:-1], dims[1:]):
        bound = 1.0 / math.sqrt(fan_in)
        params.append(rng.uniform(-bound, bound, size=(fan_out, fan_in)))
        params.append(rng.uniform(-bound, bound, size=fan_out))
    return params


def _relu_mask(dims: tuple) -> list[bool]:
    """ReLU after every layer except the code layer and the output layer."""
    code = CODE_LAYER.get(tuple(dims), (len(dims) - 1) // 2)
    n = len(dims) - 1
    return [i + 1 not in (code, n) for i in range(n)]


def forward(params: list[np.ndarray], dims: tuple, x: np.ndarray) -> tuple[np.ndarray, list]:
    acts = [x]
    h = x
    for i, relu in enumerate(_relu_mask(dims)):
        h = h @ params[2 * i].T + params[2 * i + 1]
        if relu:
            h = np.maximum(h, 0.0)
        acts.append(h)
    return h, acts


def row_loss(params, dims, x: np.ndarray) -> np.ndarray:
    out, _ = forward(params, dims, x)
    return np.mean((out - x) ** 2, axis=1)


def _grads(params, dims, x):
    """Loss (mean over rows and columns) and gradients for one minibatch."""
    out, acts = forward(params, dims, x)
    n, d = x.shape
    diff = out - x
    loss = float(np.mean(diff ** 2))
    g = 2.0 * diff / (n * d)
    grads = [None] * len(params)
    relu = _relu_mask(dims)
    for i in reversed(range(len(relu))):
        if relu[i]:
            g = g * (acts[i + 1] > 0)
        grads[2 * i] = g.T @ acts[i]
        grads[2 * i + 1] = g.sum(axis=0)
        g = g @ params[2 * i]
    return loss, grads


def _flatten(arrs) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrs])


def _unflatten(vec, like) -> list[np.ndarray]:
    out, k = [], 0
    for a in like:
        out.append(vec[k:k + a.size].reshape(a.shape))
        k += a.size
    return out


# --- scoring ------------------------------------------------------------------
def score_column(params: list[np.ndarray], dims: tuple, cols: list[str] = FEATURES) -> Column:
    """Per-row reconstruction loss as a pandas UDF column (weights travel with
    the UDF: their size is fixed by the shape, not by the data)."""
    ps = [p.copy() for p in params]
    shape = tuple(dims)

    @F.pandas_udf(T.DoubleType())
    def _score(x: pd.DataFrame) -> pd.Series:
        return pd.Series(row_loss(ps, shape, x.to_numpy(dtype=np.float64)))

    return _score(F.struct(*[F.col(c).cast("double") for c in cols]))


def weights_frame(spark, params: list[np.ndarray]) -> DataFrame:
    """Model parameters as rows (tensor, row, col, value) for storage."""
    rows = []
    for t, p in enumerate(params):
        m = p.reshape(p.shape[0], -1)
        for i in range(m.shape[0]):
            for j in range(m.shape[1]):
                rows.append((t, i, j, float(m[i, j])))
    return spark.createDataFrame(rows, "tensor int, row int, col int, value double")


def params_from_frame(df: DataFrame, dims: tuple) -> list[np.ndarray]:
    out = [np.zeros((p.shape[0], 1 if p.ndim == 1 else p.shape[1])) for p in init_params(dims)]
    for r in df.collect():  # as many rows as the shape has parameters
        out[r["tensor"]][r["row"], r["col"]] = r["value"]
    return [m.reshape(p.shape) for m, p in zip(out, init_params(dims))]


# --- training -----------------------------------------------------------------
@dataclass
class TrainResult:
    dims: tuple
    params: list
    history: list = field(default_factory=list)  # (epoch, train_loss, val_loss, lr)
    best_epoch: int = -1


PART_ROWS = 1_000_000  # some 300 MB of doubles
N_TRAIN, TRAIN_SUM, N_VAL, VAL_SUM, STEPS = -1, -2, -3, -4, -5  # keys of the counts beside the parameters


def _epoch_fn(dims, flat, m, v, t0, lr, batch, seed, epoch, learn):
    def run(it):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        like = init_params(dims)
        frames = [f for f in it if len(f)]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True)
        xs = np.stack(pdf["x"].to_numpy())
        is_val = pdf["is_val"].to_numpy(dtype=bool)
        xv, xt = xs[is_val], xs[~is_val]
        val_sum = float(row_loss(_unflatten(np.array(flat), like), dims, xv).sum()) if len(xv) else 0.0
        mm, vv, p = np.array(m), np.array(v), np.array(flat)
        loss_sum, t = 0.0, t0
        if learn:
            order = np.random.default_rng([seed, epoch, pid]).permutation(len(xt))
            for s in range(0, len(order), batch):
                p, mm, vv, t, loss = adam_step(p, mm, vv, t, xt[order[s:s + batch]], dims, like, lr)
                loss_sum += loss * min(batch, len(order) - s)
        keys = [N_TRAIN, TRAIN_SUM, N_VAL, VAL_SUM, STEPS]
        vals = [len(xt), loss_sum, len(xv), val_sum, t - t0]
        if learn:
            keys, vals = [*keys, *range(3 * len(p))], np.concatenate((vals, len(xt) * np.concatenate((p, mm, vv))))
        yield pd.DataFrame({"k": keys, "v": vals})
    return run


def adam_step(p, m, v, t, x, dims, like, lr, b1=0.9, b2=0.999, eps=1e-8):
    """One Adam step on a minibatch: (weights, first and second moments, step, loss)."""
    loss, g = _grads(_unflatten(p, like), dims, x)
    g = _flatten(g)
    t += 1
    m = b1 * m + (1 - b1) * g
    v = b2 * v + (1 - b2) * g * g
    return p - lr * (m / (1 - b1 ** t)) / (np.sqrt(v / (1 - b2 ** t)) + eps), m, v, t, loss


def training_frame(train: DataFrame, val: DataFrame, cols: list[str] = FEATURES,
                   partitions: int | None = None) -> DataFrame:
    """Rows as (x array, is_val) in ``partitions`` parts by key, sorted within each,
    written once to the checkpoint folder (read every epoch). By default four parts, or as
    many as keep a part at ``PART_ROWS`` rows, which a task holds at once."""
    if partitions is None:
        partitions = max(4, math.ceil((train.count() + val.count()) / PART_ROWS))
    def pack(df, flag):
        return df.select(*KEY_COLS, F.array(*[F.col(c).cast("double") for c in cols]).alias("x"),
                         F.lit(flag).alias("is_val"))
    both = pack(train, False).unionByName(pack(val, True))
    both = both.repartition(partitions, *KEY_COLS).sortWithinPartitions(*KEY_COLS)
    return cut_lineage(both.select("x", "is_val"))


def train(train: DataFrame, val: DataFrame, dims: tuple = SHAPE_LARGE, epochs: int = 50,
          batch: int = 2048, lr: float = 1e-3, patience: int = 5, factor: float = 0.2,
          seed: int = 42, cols: list[str] = FEATURES, partitions: int | None = None,
          frame: DataFrame | None = None) -> TrainResult:
    """``partitions`` and ``batch`` are part of the model's definition: weights are averaged
    over the partitions after every epoch; one partition is plain sequential Adam. Size
    ``partitions`` so that a part fits a task (36 doubles a row)."""
    frame = frame if frame is not None else training_frame(train, val, cols, partitions)
    flat = _flatten(init_params(dims, seed))
    m, v, t = np.zeros_like(flat), np.zeros_like(flat), 0
    best, best_epoch, best_flat = float("inf"), -1, flat.copy()
    plateau_best, bad = float("inf"), 0
    history = []
    prev_train = None
    for e in range(epochs + 1):
        learn = e < epochs  # the last pass only reads the validation loss
        fn = _epoch_fn(tuple(dims), flat.tolist(), m.tolist(), v.tolist(), t, lr, batch, seed, e, learn)
        # one row per parameter, summed by Spark
        total = (frame.mapInPandas(fn, "k int, v double").groupBy("k")
                 .agg(F.sum("v").alias("s"), F.max("v").alias("m")).toPandas().set_index("k"))
        get = lambda k: float(total["s"].get(k, 0.0))  # noqa: E731,B023
        n_val, n_tr = get(N_VAL), get(N_TRAIN)
        val_loss = get(VAL_SUM) / n_val if n_val else float("nan")
        if e > 0:
            # val_loss was measured with the weights after epoch e-1
            history.append((e, prev_train, val_loss, lr))
            if val_loss < best:
                best, best_epoch, best_flat = val_loss, e, flat.copy()
            if val_loss < plateau_best * (1 - 1e-4):
                plateau_best, bad = val_loss, 0
            else:
                bad += 1
                if bad > patience:
                    lr, bad = lr * factor, 0
        if not learn or not n_tr:
            break
        n = len(flat)
        mean = total["s"].loc[range(3 * n)].to_numpy() / n_tr
        flat, m, v = mean[:n], mean[n:2 * n], mean[2 * n:]
        t += int(total["m"][STEPS])
        prev_train = get(TRAIN_SUM) / n_tr
    return TrainResult(tuple(dims), _unflatten(best_flat, init_params(dims)), history, best_epoch)


def save(spark, path: str, params: list[np.ndarray]) -> str:
    """Write the weights as Parquet into a shared folder."""
    weights_frame(spark, params).write.mode("overwrite").parquet(path)
    return path


def load(spark, path: str, dims: tuple) -> list[np.ndarray]:
    return params_from_frame(spark.read.parquet(path), dims)


def history_frame(spark, res: TrainResult) -> DataFrame:
    return spark.createDataFrame(
        [(e, float(a), float(b), float(c)) for e, a, b, c in res.history],
        "epoch int, train_loss double, val_loss double, lr double")
