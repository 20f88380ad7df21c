"""Exact top-k search by inner product over norm buckets.

Method: candidates are sorted by length (range partitions, blocks of ``BUCKET`` rows), so
a bucket holds vectors of about one length. Every query gets a lower bound first: its k-th
best score in the bucket of the longest vectors. In a bucket with longest vector l, a
candidate can only matter if its cosine with the query reaches the local threshold
bound / (|q| l). Above 1 the bucket is passed over; else length prunes (the bucket's rows
with |p| >= bound / |q|) and, for a high threshold on vectors so wide that a product costs
more, coordinates do (the feasible interval of the candidate's unit coordinate at the
query's largest ones). Survivors are verified by their integer inner product, many queries
at a time; where lengths leave no product above 2^24, single precision gives it exactly.

Queries form blocks too. Buckets are dealt evenly to groups; a task takes the buckets of
its group into memory (``HELD`` bytes, about) and then one query block after another, which
meets the buckets from the longest on. The bound rises to the k-th best found so far, and
the block gives its k best of the whole group. Only the first bucket (``BUCKET`` rows at
most per dimension) is broadcast.

Defined cases: vectors that are null or hold null or non-finite components, and null ids,
take no part; an id given more than once counts once, with its greatest vector; vectors
only meet vectors of their dimension; a zero vector scores 0 against every one; with
fewer than k candidates all are returned; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayguard.llm.common import spool

BUCKET, QUERIES = 4096, 1024
TOGETHER = 256       # queries whose products with a bucket are held at once
GROUP = 4 * BUCKET   # rows of a group, where there are shuffle partitions enough
HELD = 64 << 20      # bytes of a group's buckets in single precision
FOCUS = 4            # coordinates that a query prunes by
COORD_FROM = 0.35    # local cosine threshold from which coordinates prune better than length
COORD_DIM = 1024     # dimension from which they cost less than the products they save
FEW = 16             # ... and the share of rows, one in FEW, that they must leave at most
MANY = 64            # hits of one query in one bucket from which its k best are cut out first
BLOCK = "dim int, first long, n int, longest double, ids binary, data binary, deal long"


def quantised(vector: Column) -> Column:
    """floor(256 x) of every component."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _narrow(m: np.ndarray) -> np.ndarray:
    """The same whole numbers in the least of 16, 32 and 64 bits."""
    lo, hi = m.min(initial=0), m.max(initial=0)
    return m.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max))


def _blocks(size: int, spread: int = 1):
    """Sorted (dim, vec_id, v) rows -> blobs of at most ``size`` rows of one dimension. ``deal``
    numbers the blocks of ``spread`` partitions, so that its remainders share them evenly."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list[np.ndarray] = []
        dim = None
        deal = TaskContext.get().partitionId()

        def out():
            m = np.stack(rows)
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "first": pa.array([ids[0]], pa.int64()), "n": pa.array([len(ids)], pa.int32()),
                "longest": [float(np.sqrt((m.astype(np.float64) ** 2).sum(1).max(initial=0)))],
                "ids": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                "data": pa.array([_narrow(m).tobytes()], pa.binary()), "deal": pa.array([deal], pa.int64())})

        for batch in batches:
            v = batch.column(2)
            flat, at = np.asarray(v.flatten(), np.int64), np.asarray(v.offsets)
            at = at - at[0]
            for i, (d, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if rows and (d != dim or len(rows) >= size):
                    yield out()
                    ids, rows, deal = [], [], deal + spread
                dim = d
                ids.append(key)
                rows.append(flat[at[i]:at[i + 1]])
        if rows:
            yield out()

    return blocks


def _matrix(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    width = len(data) // (len(ids) * dim) if dim else 8
    return ids, np.frombuffer(data, f"i{width}").reshape(len(ids), dim)


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(np.float64) ** 2).sum(1))


def _exact(longest_q: float, longest_p: float) -> type:
    """The fastest type with exact products: no sum of some of a product's terms exceeds the
    lengths' product, and whole numbers are exact below 2^24 or 2^53."""
    most = longest_q * longest_p * (1 + 1e-9)
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each row, or the lowest number where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]


def best_of(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each ``row``, by row, score and id."""
    order = np.lexsort((ids, -score, row))
    row = row[order]
    start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(start, np.diff(np.r_[start, len(row)]))
    return order[rank < k]


class Bucket:
    """Candidates by falling length, kept in each type that products were asked in."""

    def __init__(self, p: np.ndarray, pids: np.ndarray):
        lp = _norms(p)
        self.order = np.argsort(-lp, kind="stable")
        self.p, self.pids, self.lp = p[self.order], pids[self.order], lp[self.order]
        self.longest = float(self.lp[0]) if len(lp) else 0.0
        self.typed: dict = {}

    def product(self, q: np.ndarray, longest_q: float, rows: slice | np.ndarray) -> np.ndarray:
        t = _exact(longest_q, self.longest)
        if t not in self.typed:
            self.typed[t] = self.p.astype(t)
        return q.astype(t) @ self.typed[t][rows].T

    def best(self, q: np.ndarray, qids: np.ndarray, lq: np.ndarray, bound: np.ndarray, k: int):
        """(query row, place in the bucket, score) of each query's k best at or above its bound."""
        z = np.zeros(0, np.int64)
        if not len(self.pids) or not len(q):
            return z, z, z
        longest_q = float(lq.max())
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(lq > 0, bound / np.where(lq > 0, lq, 1), np.where(bound > 0, np.inf, -np.inf))
            local = np.where(self.longest > 0, need / max(self.longest, 1e-300), np.where(need > 0, np.inf, -np.inf))
        slack = 1e-9
        prefix = np.searchsorted(-self.lp, -(need * (1 - slack) - slack), side="right")
        prefix = np.where(need <= 0, len(self.lp), prefix)
        feasible = local <= 1 + slack
        coords = (local >= COORD_FROM) & (q.shape[1] >= COORD_DIM)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def keep(i: np.ndarray, rows: np.ndarray, s: np.ndarray) -> None:
            ok = self.pids[rows] != qids[i]
            i, rows, s = i[ok], rows[ok], s[ok].astype(np.int64)
            top = best_of(i, self.pids[rows], s, k)
            out.append((i[top], rows[top], s[top]))

        dense = feasible & ~coords
        if (feasible & coords).any():
            unit = self.p / np.where(self.lp > 0, self.lp, 1)[:, None]
        for i in np.flatnonzero(feasible & coords).tolist():
            n = int(prefix[i])
            u, t = q[i] / lq[i], np.minimum(need[i] / np.where(self.lp[:n] > 0, self.lp[:n], 1), 1.0)
            rows = np.arange(n)
            for f in np.argsort(-np.abs(u), kind="stable")[:FOCUS].tolist():
                # cos >= t needs the unit coordinate within u t -+ sqrt((1 - u^2)(1 - t^2))
                tt = t[rows]
                half = np.sqrt(max(0.0, 1 - u[f] ** 2) * np.maximum(0, 1 - tt ** 2))
                c = unit[rows, f] * (1 if u[f] >= 0 else -1)
                rows = rows[c >= abs(u[f]) * tt - half - 1e-7]  # the bound below; above it a larger cosine is fine
            if FEW * len(rows) > n:  # one by one they would cost more than with the other queries
                dense[i] = True
                continue
            s = self.product(q[i:i + 1], longest_q, rows)[0]
            ok = s >= bound[i]
            keep(np.full(int(ok.sum()), i), rows[ok], s[ok])
        by_length = np.flatnonzero(dense)
        by_length = by_length[np.argsort(-prefix[by_length], kind="stable")]  # queries that reach equally far together
        for lo in range(0, len(by_length), TOGETHER):
            part = by_length[lo:lo + TOGETHER]
            s = self.product(q[part], longest_q, slice(0, int(prefix[part[0]])))
            least = np.clip(np.ceil(bound[part]), -2.0 ** 62, 2.0 ** 62)
            if s.dtype == np.float32:
                least = np.clip(least, -2.0 ** 25, 2.0 ** 25)  # no product is beyond
            hit = s >= least.astype(s.dtype)[:, None]  # rows past a query's own prefix are below its bound
            n = np.count_nonzero(hit, axis=1)
            for j in np.flatnonzero(n > max(MANY, 2 * k)).tolist():  # the query itself may be one of them
                hit[j] &= s[j] >= np.partition(s[j], s.shape[1] - k - 1)[-k - 1]
            at = np.flatnonzero(hit)
            i, rows = np.divmod(at, max(1, s.shape[1]))
            keep(part[i], rows, s.ravel()[at])
        if not out:
            return z, z, z
        return tuple(np.concatenate([o[j] for o in out]) for j in range(3))


def bounds(queries: np.ndarray, qids: np.ndarray, probe: np.ndarray, pids: np.ndarray, k: int) -> np.ndarray:
    b, lq = Bucket(probe, pids), _norms(queries)
    out = np.full(len(queries), -np.inf)
    for lo in range(0, len(queries), TOGETHER):
        s = b.product(queries[lo:lo + TOGETHER], float(lq.max(initial=0)), slice(None)).astype(np.float64)
        s[qids[lo:lo + TOGETHER, None] == b.pids[None, :]] = -np.inf
        out[lo:lo + TOGETHER] = _kth(s, k)
    return out


def search_bucket(q: np.ndarray, qids: np.ndarray, bound: np.ndarray, p: np.ndarray, pids: np.ndarray, k: int):
    """(query row, candidate row, score) of each query's k best at or above its bound."""
    b = Bucket(p, pids)
    i, rows, s = b.best(q, qids, _norms(q), bound, k)
    return i, b.order[rows], s


def search_buckets(q: np.ndarray, qids: np.ndarray, bound: np.ndarray, buckets: list[Bucket], k: int):
    """(query row, candidate id, score) of each query's k best of all buckets at or above its
    bound, which rises to the k-th best score found so far."""
    lq, bound = _norms(q), bound.copy()
    row, ids, score = (np.zeros(0, np.int64) for _ in range(3))
    for b in sorted(buckets, key=lambda b: -b.longest):
        i, at, s = b.best(q, qids, lq, bound, k)
        if len(i):
            row, ids, score = np.r_[row, i], np.r_[ids, b.pids[at]], np.r_[score, s]
            top = best_of(row, ids, score, k)
            row, ids, score = row[top], ids[top], score[top]
            last = np.flatnonzero(np.r_[row[1:] != row[:-1], True])
            full = last[np.bincount(row, minlength=len(q))[row[last]] >= k]
            bound[row[full]] = np.maximum(bound[row[full]], score[full])
    return row, ids, score


def _bound_blocks(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                dim = one["dim"][0].as_py()
                ids, q = _matrix(one["ids"][0].as_py(), one["data"][0].as_py(), dim)
                if one["p_ids"][0].as_py() is None:
                    b = np.full(len(ids), -np.inf)
                else:
                    pids, p = _matrix(one["p_ids"][0].as_py(), one["p_data"][0].as_py(), dim)
                    b = bounds(q, ids, p, pids, k)
                yield pa.RecordBatch.from_pydict({"dim": one["dim"], "first": one["first"], "ids": one["ids"],
                                                  "data": one["data"], "bound": pa.array([b.tobytes()], pa.binary())})

    return run


def _search(k: int):
    """Rows sorted by group, buckets (without bounds) before query blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                if one["part"][0].as_py() != part:
                    part, held = one["part"][0].as_py(), {}
                dim, bound = one["dim"][0].as_py(), one["bound"][0].as_py()
                ids, m = _matrix(one["ids"][0].as_py(), one["data"][0].as_py(), dim)
                if bound is None:
                    held.setdefault(dim, []).append(Bucket(m, ids))
                    continue
                a, found, s = search_buckets(m, ids, np.frombuffer(bound), held.get(dim, []), k)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(ids[a], pa.int64()), "vec_id": pa.array(found, pa.int64()),
                                                  "score": pa.array(s, pa.int64())})

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``vectors`` (vec_id, v: whole numbers); ``is_query`` picks the queries. Returns
    (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    v = spool(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<long>").alias("v"))
              .where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("vec_id").agg(F.max("v").alias("v"))
              .withColumn("dim", F.size("v"))
              .withColumn("len2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n, cells = v.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("dim").cast("long")), F.lit(0))).first()
    spread = min(parts, n // BUCKET + 1)  # blocks are whole where there are few rows
    buckets = spool(v.repartitionByRange(spread, "dim", F.desc("len2"), "vec_id")
                    .sortWithinPartitions("dim", F.desc("len2"), "vec_id").select("dim", "vec_id", "v")
                    .mapInArrow(_blocks(BUCKET, spread), BLOCK))
    asking = v.where(is_query).select("dim", "vec_id", "v")
    queries = (asking.repartitionByRange(min(parts, asking.count() // QUERIES + 1), "dim", "vec_id")
               .sortWithinPartitions("dim", "vec_id").mapInArrow(_blocks(QUERIES), BLOCK))
    # the bucket of the longest vectors of each dimension: at most BUCKET rows
    first = Window.partitionBy("dim").orderBy(F.desc("longest"), "first")
    heads = (buckets.select("dim", "longest", "first").withColumn("r", F.row_number().over(first)).where("r = 1")
             .select("dim", "first"))
    probe = buckets.join(heads, ["dim", "first"]).select("dim", F.col("ids").alias("p_ids"), F.col("data").alias("p_data"))
    asked = spool(queries.join(F.broadcast(probe), "dim", "left").mapInArrow(
        _bound_blocks(k), "dim int, first long, ids binary, data binary, bound binary"))
    # every query block meets every bucket of its dimension: buckets are dealt to groups once,
    # and each query block (a fiftieth of the rows, say) goes to every group that has its dimension
    groups = max(min(parts, -(-n // GROUP)), -(-4 * cells // HELD), 1)
    dealt = buckets.withColumn("part", F.pmod("deal", F.lit(groups)).cast("int"))
    copies = asked.join(F.broadcast(dealt.select("dim", "part").distinct()), "dim")
    cols = ["part", "dim", "first", "ids", "data", "bound"]
    met = (dealt.withColumn("bound", F.lit(None).cast("binary")).select(*cols).unionByName(copies.select(*cols))
           .repartitionById(groups, "part").sortWithinPartitions("part", F.col("bound").isNotNull(), "dim", "first"))
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
