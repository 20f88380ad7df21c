"""Exact quantile (numpy 'linear' rule) without sorting the table in one task.

Values are grouped first, so ties cost nothing; approximate quantiles of the distinct
values cut them into buckets, and a running count inside each bucket on top of the
buckets' totals gives every value its ranks. Only the one or two values at the wanted
ranks are fetched.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayguard.session import cut_lineage


def exact_quantiles(df: DataFrame, col: str, qs: list[float]) -> list[float | None]:
    """The quantiles of the non-null, non-NaN values, from one grouping of the table."""
    d = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    g = cut_lineage(d.groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    buckets = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted(set(g.approxQuantile("v", [i / buckets for i in range(1, buckets)], 0.25 / buckets)))
    at = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x < F.col("v"))) if cuts else F.lit(0)
    g = g.withColumn("bucket", at)
    totals = {r["bucket"]: r["n"] for r in g.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # one row per bucket
    n = sum(totals.values())
    if not n:
        return [None] * len(qs)
    before, run = [], 0
    for b in range(len(cuts) + 1):
        before.append(run)
        run += totals.get(b, 0)
    upto = F.sum("n").over(Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = g.withColumn("end", upto + F.element_at(F.array(*map(F.lit, before)), F.col("bucket") + 1))
    ranks = sorted({r for q in qs for r in _ranks(n, q)[:2]})
    hit = F.lit(False)
    for r in ranks:
        hit = hit | ((F.col("end") > r) & (F.col("end") - F.col("n") <= r))
    rows = ranked.where(hit).select("v", "n", "end").collect()  # at most two values a quantile
    value = {r: next(x["v"] for x in rows if x["end"] - x["n"] <= r < x["end"]) for r in ranks}
    return [value[lo] + (value[hi] - value[lo]) * part for lo, hi, part in (_ranks(n, q) for q in qs)]


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    pos = (n - 1) * q
    lo = int(math.floor(pos))
    return lo, min(lo + 1, n - 1), pos - lo


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    return exact_quantiles(df, col, [q])[0]
