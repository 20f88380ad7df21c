"""One-class SVM in its dual, on Nystroem landmarks, with a duality gap.

The dual min 1/2 a'Ka, 0 <= a_i <= 1/(nu n), sum a = 1, asks for the point of least norm in
the reduced convex hull of the mapped rows. With ``landmarks`` rows L chosen by key hash the
kernel is K = Z Z', z(x) = k(x, L) U D^(-1/2) (Williams, Seeger 2001; exact when all rows are
landmarks), and the hull lies in as many dimensions.

Simplicial decomposition (von Hohenbalken 1977; Wolfe 1976): the master problem keeps at
most dimensions + 1 hull points, small dense algebra on the driver; the subproblem asks all
rows for the hull point lowest in direction w, the mean of the nu n rows with the smallest
w.z. That is two aggregations per round: a histogram of the scores finds the bin of the
wanted rank, then sums of z below it and in 256 cuts of it. What is left is spread evenly
over one cut, so the point is feasible and off the best by less than a cut.

|w|^2 - w.v, v bounded from below by the cut's edge, is the duality gap: a certificate, not
an estimate. Mapped rows are written once, as blocks of ``BLOCK`` rows of doubles that a task
takes as one array without touching single values, and read each round; all nu share the
rounds. The offset is the exact nu-quantile of the training scores.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.functions.columns import hash_unit
from dayguard.functions.quantile import exact_quantile
from dayguard.schema import FEATURES, KEY_COLS
from dayguard.session import ensure_checkpoint_dir

BINS, CUTS = 4096, 256
BLOCK = 1024  # mapped rows in one stored value (512 KB at 64 dimensions)


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * x @ y.T
    return np.exp(-gamma * np.maximum(d, 0.0))


def nystroem(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """Matrix M with z(x) = k(x, landmarks) M."""
    values, vectors = np.linalg.eigh(rbf(landmarks, landmarks, gamma))
    keep = values > 1e-10 * values.max()
    return vectors[:, keep] / np.sqrt(values[keep])


@dataclass
class DualModel:
    landmarks: np.ndarray
    mapping: np.ndarray
    w: np.ndarray
    rho: float
    nu: float
    gamma: float
    gap: float      # duality gap
    rounds: int


def _mapped(x: np.ndarray, landmarks, mapping, gamma) -> np.ndarray:
    return rbf(x, landmarks, gamma) @ mapping


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column whose lists have ``width`` doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _blocks(batches, width: int):
    """The stored blocks as arrays of rows."""
    for b in batches:
        for block in b.column(0):
            yield np.frombuffer(block.as_buffer(), dtype=np.float64).reshape(-1, width)


def decision_column(m: DualModel, cols: list[str] = FEATURES) -> Column:
    """w.z(x) - rho: negative = outlier."""
    landmarks, mapping, w, rho, gamma = m.landmarks, m.mapping, m.w, float(m.rho), m.gamma

    @F.pandas_udf(T.DoubleType())
    def _d(x: pd.DataFrame) -> pd.Series:
        return pd.Series(_mapped(x.to_numpy(dtype=np.float64), landmarks, mapping, gamma) @ w - rho)

    return _d(F.struct(*[F.col(c).cast("double") for c in cols]))


def predict_column(m: DualModel, cols: list[str] = FEATURES) -> Column:
    return F.when(decision_column(m, cols) < 0, -1).otherwise(1)


# --- subproblem: the lowest hull points for some directions ------------------------
def _histogram(z: DataFrame, ws: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Rows per bin of the scores w.z over [-|w|, |w|]."""
    def run(it):
        out = {i: np.zeros(BINS, dtype=np.int64) for i in ws}
        for x in _blocks(it, _width(ws)):
            for i, w in ws.items():
                out[i] += np.bincount(_bin(x @ w, w), minlength=BINS)
        for i, n in out.items():
            at = np.flatnonzero(n)
            yield _batch(i=(np.full(len(at), i), pa.int32()), b=(at, pa.int32()), n=(n[at], pa.int64()))
    got = z.mapInArrow(run, "i int, b int, n long").groupBy("i", "b").agg(F.sum("n").alias("n")).toPandas()
    out = {i: np.zeros(BINS, dtype=np.int64) for i in ws}
    for i, part in got.groupby("i"):
        out[i][part["b"].to_numpy()] = part["n"].to_numpy()
    return out


def _width(ws: dict[int, np.ndarray]) -> int:
    return len(next(iter(ws.values())))


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def _bin(score: np.ndarray, w: np.ndarray) -> np.ndarray:
    reach = float(np.linalg.norm(w)) or 1.0  # |z| <= 1, as k(x, x) = 1
    return np.clip(((score / reach + 1.0) * (BINS / 2)).astype(np.int64), 0, BINS - 1)


def _cut(score: np.ndarray, w: np.ndarray, b: int) -> np.ndarray:
    reach = float(np.linalg.norm(w)) or 1.0
    return np.clip((((score / reach + 1.0) * (BINS / 2) - b) * CUTS).astype(np.int64), 0, CUTS - 1)


def _edge(w: np.ndarray, b: int, c: int) -> float:
    reach = float(np.linalg.norm(w)) or 1.0
    return ((b + c / CUTS) / (BINS / 2) - 1.0) * reach


def lowest_points(z: DataFrame, n: int, ws: dict[int, np.ndarray], mass: dict[int, float]) -> dict[int, tuple[np.ndarray, float]]:
    """Per direction: (hull point, lower bound of w.v over the hull). ``mass``: rows' weight in all."""
    at = {}
    for i, h in _histogram(z, ws).items():
        upto = np.cumsum(h)
        at[i] = int(np.searchsorted(upto, min(mass[i], upto[-1])))

    def run(it):
        sums: dict = {}
        for x in _blocks(it, _width(ws)):
            for i, w in ws.items():
                s = x @ w
                b = _bin(s, w)
                low, mid = b < at[i], b == at[i]
                c, rest = _cut(s[mid], w, at[i]), x[mid]
                for key, rows in [(-1, x[low]), *[(int(k), rest[c == k]) for k in np.unique(c)]]:
                    if len(rows):
                        old = sums.get((i, key))
                        new = np.concatenate(([len(rows)], rows.sum(axis=0)))
                        sums[(i, key)] = new if old is None else old + new
        for (i, key), v in sums.items():
            n = len(v)
            yield _batch(i=(np.full(n, i), pa.int32()), c=(np.full(n, key), pa.int32()), j=(np.arange(n), pa.int32()), v=(v, pa.float64()))

    got = z.mapInArrow(run, "i int, c int, j int, v double").groupBy("i", "c", "j").agg(F.sum("v").alias("v")).toPandas()
    out = {}
    for i, w in ws.items():
        mine = got[got["i"] == i].pivot(index="c", columns="j", values="v").sort_index()
        total, left, bound = np.zeros(len(w)), mass[i], 0.0
        for c, row in zip(mine.index, mine.to_numpy()):
            count, vec = row[0], row[1:]
            share = min(1.0, left / count)
            total += share * vec
            bound += w @ vec if c < 0 or share == 1.0 else left * _edge(w, at[i], c)
            left -= share * count
            if left <= 1e-12 * mass[i]:
                break
        out[i] = total / mass[i], bound / mass[i]
    return out


# --- master problem: least norm among convex combinations of hull points -----------
class Corral:
    """Wolfe's least-norm point over the hull points seen so far."""

    def __init__(self, point: np.ndarray):
        self.points, self.weights = [point], np.array([1.0])

    @property
    def w(self) -> np.ndarray:
        return self.weights @ np.array(self.points)

    def add(self, point: np.ndarray) -> None:
        self.points.append(point)
        self.weights = np.append(self.weights, 0.0)
        while True:
            p = np.array(self.points)
            k = len(p)
            system = np.zeros((k + 1, k + 1))
            system[:k, :k], system[:k, k], system[k, :k] = p @ p.T, 1.0, 1.0
            flat = np.linalg.lstsq(system, np.append(np.zeros(k), 1.0), rcond=None)[0][:k]
            if (flat > 1e-12).all():
                self.weights = flat / flat.sum()
                return
            down = flat <= 1e-12
            room = self.weights[down] - flat[down]
            step = min(1.0, float(np.min(self.weights[down] / np.where(room > 0, room, 1.0)))) if down.any() else 1.0
            mixed = self.weights + step * (flat - self.weights)
            keep = mixed > 1e-12
            if keep.all() or not keep.any():
                keep[int(np.argmin(mixed))] = False
            self.points = [q for q, ok in zip(self.points, keep) if ok]
            self.weights = mixed[keep] / mixed[keep].sum()
            if len(self.points) == 1:
                return


def fit(train: DataFrame, nus: list[float], gamma: float = 0.1, landmarks: int = 64, tolerance: float = 1e-4,
        max_rounds: int = 100, seed: int = 42, cols: list[str] = FEATURES) -> list[DualModel]:
    """One model per nu, solved to a gap of ``tolerance`` x |w|^2 (or ``max_rounds`` rounds;
    the gap reached is in the model). Rows with equal key hashes are ordered by key."""
    x = F.array(*[F.col(c).cast("double") for c in cols]).alias("x")
    chosen = train.select(hash_unit([KEY_COLS[0]], [KEY_COLS[1]], seed).alias("u"), *KEY_COLS, x).orderBy("u", *KEY_COLS, "x").limit(landmarks)
    points = np.array([r["x"] for r in chosen.collect()])  # ``landmarks`` rows
    if not len(points):
        return []
    mapping = nystroem(points, gamma)

    width = mapping.shape[1]

    def mapped(it):
        for b in it:
            rows = _mapped(_rows(b.column(0), len(cols)), points, mapping, gamma)
            parts = [rows[s:s + BLOCK].tobytes() for s in range(0, len(rows), BLOCK)]
            yield _batch(z=(parts, pa.binary()))

    def summed(it):
        total = np.zeros(1 + width)
        for rows in _blocks(it, width):
            total += np.concatenate(([len(rows)], rows.sum(axis=0)))
        yield _batch(j=(np.arange(1 + width), pa.int32()), v=(total, pa.float64()))

    path = f"{ensure_checkpoint_dir(train.sparkSession).rstrip('/')}/mapped-{uuid.uuid4().hex}"
    train.select(x).mapInArrow(mapped, "z binary").write.parquet(path)
    z = train.sparkSession.read.schema("z binary").parquet(path)
    sums = z.mapInArrow(summed, "j int, v double").groupBy("j").agg(F.sum("v").alias("v")).orderBy("j").collect()  # a row per dimension
    n, mean = int(sums[0]["v"]), np.array([r["v"] for r in sums[1:]]) / sums[0]["v"]
    mass = {i: max(1.0, nu * n) for i, nu in enumerate(nus)}
    corrals = {i: Corral(mean) for i in mass}  # the kernel mean is a point of every reduced hull
    gaps, rounds, open_ = dict.fromkeys(mass, np.inf), dict.fromkeys(mass, 0), set(mass)
    for _ in range(max_rounds):
        ws = {i: corrals[i].w for i in sorted(open_)}
        for i, (v, bound) in lowest_points(z, n, ws, mass).items():
            w, rounds[i] = ws[i], rounds[i] + 1
            gaps[i] = float(w @ w - bound)
            if gaps[i] <= tolerance * float(w @ w) or w @ w - w @ v <= 1e-14:
                open_.discard(i)
            else:
                corrals[i].add(v)
        if not open_:
            break
    out = []
    for i, nu in enumerate(nus):
        m = DualModel(points, mapping, corrals[i].w if i not in open_ else ws[i], 0.0, nu, gamma, gaps[i], rounds[i])
        m.rho = exact_quantile(train.select(decision_column(m, cols).alias("d")), "d", nu)
        out.append(m)
    return out
