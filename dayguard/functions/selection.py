"""Exact-size samples: the k rows with the smallest seeded key hash, found without a sort.

A histogram of the hash's leading bits finds the bucket that holds the k-th row, and the
same again inside it, until the few hashes left can be fetched; rows are then kept by a
comparison with that one hash. The same bits come out of Spark and DuckDB, so the choice
depends on the keys alone, never on partitioning or retries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayguard.functions.columns import key_text

BITS, STEP, FETCH = 60, 12, 10_000  # FETCH: distinct hashes that may be fetched


def key_hash(cols: list[str], seed: int) -> Column:
    """The first 60 bits of md5(seed|col|col...), as a long."""
    return F.expr(f"CAST(conv(substring(md5({key_text(cols, seed, 'spark')}), 1, 15), 16, 10) AS BIGINT)")


def key_hash_sql(cols: list[str], seed: int) -> str:
    """The same number as DuckDB SQL text."""
    return f"CAST(('0x' || substr(md5({key_text(cols, seed, 'duckdb')}), 1, 15)) AS BIGINT)"


def kth_smallest(hashes: DataFrame, k: int) -> tuple[int, int, int]:
    """(value of the k-th smallest ``h``, rows below it, rows equal to it); k from 1."""
    left, below, prefix, shift = k, 0, 0, BITS
    while True:
        mine = hashes if shift == BITS else hashes.where(F.shiftright("h", shift) == prefix)
        next_ = shift - STEP
        counts = mine.groupBy(F.shiftright("h", next_).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()  # 4096 rows at most
        for r in counts:
            if left <= r["n"]:
                break
            left, below = left - r["n"], below + r["n"]
        prefix, shift, n = r["p"], next_, r["n"]
        if shift == 0:
            return prefix, below, n
        if n <= FETCH:
            inside = hashes.where(F.shiftright("h", shift) == prefix).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
            for r in inside.orderBy("h").collect():
                if left <= r["n"]:
                    return r["h"], below, r["n"]
                left, below = left - r["n"], below + r["n"]


def mark_smallest(df: DataFrame, k: int, cols: list[str], seed: int, name: str = "picked") -> DataFrame:
    """``df`` with a flag on exactly k rows (all, if fewer). Rows of one key hash are ordered by
    their columns; beyond that they are equal and any of them will do."""
    if k <= 0:
        return df.withColumn(name, F.lit(False))
    h = key_hash(cols, seed)
    hashes = df.select(h.alias("h"))
    if df.count() <= k:
        return df.withColumn(name, F.lit(True))
    value, below, equal = kth_smallest(hashes, k)
    if below + equal == k:
        return df.withColumn(name, h <= value)
    rest = df.where(h != value).withColumn(name, h < value)
    number = F.row_number().over(Window.partitionBy("_h").orderBy(*[F.col(c) for c in df.columns]))
    tied = df.withColumn("_h", h).where(F.col("_h") == value).withColumn(name, number <= k - below).drop("_h")
    return rest.unionByName(tied)


def share_of(n: int, frac: float) -> int:
    """Rows of an exact share: ceil(n x frac), as the usual splitters count."""
    return min(n, math.ceil(n * frac))
