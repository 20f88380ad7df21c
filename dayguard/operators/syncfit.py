"""Synchronous minibatch training: a step is ``batch`` rows of one global shuffle, on any
number of partitions.

Rows get dense positions once (range sort by key, rows per partition added up), and every
epoch a seeded permutation of the positions, computed row by row without a sort, deals them
to steps. The weights after a step depend only on the data, the seed and the batch size, so
they are the same bits for any partitioning, retry or cluster.

Two plans, by what a step costs:

* relay (a step fits a task): an epoch is dealt to runs of ``run_rows`` rows by one shuffle;
  each run is one task that starts from the weights of the run before it, streams its rows
  in order and returns the weights. Steps depend on each other, so at a batch of 2,048 rows
  (some 5 ms of arithmetic) there is nothing to gain from splitting a step: an exchange of
  gradients inside a barrier stage takes 0.8 to 1.0 s on Spark, whose barrier calls wait in
  one-second naps (measured here with 30 KB from 3 tasks);
* summed (a step is larger than a task, up to the full batch): all tasks add up gradients of
  the step's rows and Spark sums them per parameter.

Weights and moments (three numbers a parameter) are all that crosses the driver.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.operators import autoencoder as ae
from dayguard.schema import FEATURES, KEY_COLS
from dayguard.session import cut_lineage, ensure_checkpoint_dir

RUN_ROWS = 200_000  # rows of one relay task (58 MB at 36 doubles)


def placed(train: DataFrame, cols: list[str] = FEATURES, partitions: int | None = None) -> DataFrame:
    """(at: dense position in key order, x: array of the columns). Equal keys are ordered by x."""
    spark = train.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = train.select(*KEY_COLS, F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    rows = cut_lineage(rows.repartitionByRange(n, *KEY_COLS, "x").sortWithinPartitions(*KEY_COLS, "x"))
    pid = F.spark_partition_id()
    sizes = {r["p"]: r["n"] for r in rows.groupBy(pid.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a partition
    before = np.concatenate(([0], np.cumsum([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)])))[:-1]
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start = F.element_at(F.array(*[F.lit(int(b)) for b in before]), pid + 1)
    return cut_lineage(rows.select((inside + start).alias("at"), "x"))


def permuted(at: np.ndarray, n: int, seed: int, epoch: int) -> np.ndarray:
    """Places of the positions ``at`` in a seeded permutation of 0..n-1: a Feistel network on
    the next power of four, walked on while it leaves the range."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng([seed, epoch]).integers(0, 2 ** 63, size=4, dtype=np.uint64)

    def once(v):
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            with np.errstate(over="ignore"):
                h = (right + k) * np.uint64(0x9E3779B97F4A7C15)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((h >> np.uint64(31)) & mask)
        return (left << np.uint64(half)) | right

    out = once(at.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def place_column(n: int, seed: int, epoch: int) -> Column:
    @F.pandas_udf(T.LongType())
    def _p(at: pd.Series) -> pd.Series:
        return pd.Series(permuted(at.to_numpy(dtype=np.int64), n, seed, epoch))
    return _p(F.col("at"))


def _relay(dims, state, lr, batch):
    """Rows in order of ``place`` -> state (p, m, v, t) after their steps and the summed loss."""
    def run(it):
        like = ae.init_params(dims)
        size = sum(a.size for a in like)
        vec = np.asarray(state[0])
        p, m, v, t = vec[:size].copy(), vec[size:2 * size].copy(), vec[2 * size:].copy(), state[1]
        held, loss_sum, rows = [], 0.0, 0
        def step(x, p, m, v, t):
            return ae.adam_step(p, m, v, t, x, dims, like, lr)
        for f in it:
            if not len(f):
                continue
            held.append(np.stack(f["x"].to_numpy()))
            have = np.concatenate(held)
            full = len(have) // batch * batch
            for s in range(0, full, batch):
                p, m, v, t, loss = step(have[s:s + batch], p, m, v, t)
                loss_sum, rows = loss_sum + loss * batch, rows + batch
            held = [have[full:]]
        last = held[0] if held else np.empty((0, dims[0]))
        if len(last):
            p, m, v, t, loss = step(last, p, m, v, t)
            loss_sum, rows = loss_sum + loss * len(last), rows + len(last)
        yield pd.DataFrame({"k": np.arange(-3, 3 * size), "v": np.concatenate(([rows, loss_sum, t], p, m, v))})
    return run


def gradient_sums(rows: DataFrame, dims: tuple, params: list[np.ndarray]) -> tuple[np.ndarray, float, int]:
    """(summed gradient, summed loss, rows) of one step over all rows of ``rows`` (column x)."""
    flat, shape = ae._flatten(params), tuple(dims)

    def run(it):
        like = ae.init_params(shape)
        ps, total, loss_sum, n = ae._unflatten(flat, like), np.zeros(len(flat)), 0.0, 0
        for f in it:
            if len(f):
                x = np.stack(f["x"].to_numpy())
                loss, g = ae._grads(ps, shape, x)
                total += len(x) * ae._flatten(g)
                loss_sum, n = loss_sum + loss * len(x), n + len(x)
        yield pd.DataFrame({"k": np.arange(-2, len(flat)), "v": np.concatenate(([n, loss_sum], total))})

    s = rows.select("x").mapInPandas(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas().set_index("k")["v"]
    n = int(s.get(-2, 0))
    return s.reindex(range(len(flat)), fill_value=0.0).to_numpy(), float(s.get(-1, 0.0)), n


def _adam(p, m, v, t, g, lr, b1=0.9, b2=0.999, eps=1e-8):
    t += 1
    m, v = b1 * m + (1 - b1) * g, b2 * v + (1 - b2) * g * g
    return p - lr * (m / (1 - b1 ** t)) / (np.sqrt(v / (1 - b2 ** t)) + eps), m, v, t


def full_batch_step(train: DataFrame, dims: tuple, params: list[np.ndarray], lr: float = 1e-3,
                    cols: list[str] = FEATURES) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(mean gradient, weights after one Adam step) over all rows of ``train``."""
    rows = train.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    g, _, n = gradient_sums(rows, dims, params)
    g = g / max(n, 1)
    p = ae._flatten(params)
    return ae._unflatten(g, params), ae._unflatten(_adam(p, np.zeros_like(p), np.zeros_like(p), 0, g, lr)[0], params)


def _epoch(rows: DataFrame, n: int, dims, p, m, v, t, lr, batch, seed, epoch, run_rows):
    """State after one epoch and its mean training loss."""
    size = len(p)
    dealt = rows.withColumn("place", place_column(n, seed, epoch))
    if batch <= run_rows:
        run = run_rows // batch * batch
        runs, loss_sum = math.ceil(n / run), 0.0
        if runs > 1:
            path = f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/epoch-{uuid.uuid4().hex}"
            dealt = dealt.withColumn("run", F.floor(F.col("place") / run))
            dealt.repartition(runs, "run").write.partitionBy("run").parquet(path)
        for r in range(runs):
            part = dealt if runs == 1 else rows.sparkSession.read.schema("at long, x array<double>, place long").parquet(f"{path}/run={r}")
            fn = _relay(tuple(dims), (np.concatenate((p, m, v)), t), lr, batch)
            # one task: at most run_rows rows, in order
            out = part.select("place", "x").repartition(1).sortWithinPartitions("place").mapInPandas(fn, "k long, v double")
            s = out.toPandas().set_index("k")["v"]
            loss_sum, t = loss_sum + s[-2], int(s[-1])
            state = s.loc[range(3 * size)].to_numpy()
            p, m, v = state[:size], state[size:2 * size], state[2 * size:]
        return p, m, v, t, loss_sum / max(n, 1)
    like, loss_sum = ae.init_params(dims), 0.0
    for s in range(0, n, batch):
        mine = dealt.where((F.col("place") >= s) & (F.col("place") < s + batch))
        g, loss, k = gradient_sums(mine, dims, ae._unflatten(p, like))
        p, m, v, t = _adam(p, m, v, t, g / max(k, 1), lr)
        loss_sum += loss
    return p, m, v, t, loss_sum / max(n, 1)


def mean_loss(rows: DataFrame, dims: tuple, params: list[np.ndarray], cols: list[str] = FEATURES) -> float:
    """Mean reconstruction loss over all rows (NaN without rows)."""
    r = rows.select(ae.score_column(params, dims, cols).alias("s")).agg(F.avg("s")).first()[0]
    return float("nan") if r is None else float(r)


def train(train: DataFrame, val: DataFrame, dims: tuple = ae.SHAPE_LARGE, epochs: int = 50, batch: int = 2048,
          lr: float = 1e-3, patience: int = 5, factor: float = 0.2, seed: int = 42, cols: list[str] = FEATURES,
          run_rows: int = RUN_ROWS, partitions: int | None = None) -> ae.TrainResult:
    """The published training loop: shuffled minibatch Adam, plateau rule and best
    validation epoch. ``run_rows`` and ``partitions`` do not change the weights as long as a
    step fits a task (above, only the order of the sums does)."""
    rows, val = placed(train, cols, partitions), cut_lineage(val)
    n = rows.count()
    p = ae._flatten(ae.init_params(dims, seed))
    m, v, t = np.zeros_like(p), np.zeros_like(p), 0
    best, best_epoch, best_p = float("inf"), -1, p.copy()
    plateau, bad, history = float("inf"), 0, []
    for e in range(epochs if n else 0):
        p, m, v, t, loss = _epoch(rows, n, tuple(dims), p, m, v, t, lr, batch, seed, e, run_rows)
        val_loss = mean_loss(val, dims, ae._unflatten(p, ae.init_params(dims)), cols)
        history.append((e + 1, loss, val_loss, lr))
        if val_loss < best:
            best, best_epoch, best_p = val_loss, e + 1, p.copy()
        if val_loss < plateau * (1 - 1e-4):
            plateau, bad = val_loss, 0
        else:
            bad += 1
            if bad > patience:
                lr, bad = lr * factor, 0
    return ae.TrainResult(tuple(dims), ae._unflatten(best_p, ae.init_params(dims)), history, best_epoch)
