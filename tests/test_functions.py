import math

import numpy as np
from pyspark.sql import functions as F

from dayguard.functions.columns import hash_unit, ts_in_days
from dayguard.functions.quantile import exact_quantile


def test_hash_sample_independent_of_partitioning(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("c"),
                                     F.date_add(F.lit("2024-01-01").cast("date"),
                                                (F.col("id") % 30).cast("int")).alias("d"))
    u = hash_unit(["c"], ["d"], 42)
    a = {r.c for r in df.where(u < 0.2).collect()}
    b = {r.c for r in df.repartition(7, "d").where(u < 0.2).collect()}
    assert a == b
    assert 0.15 < len(a) / 3000 < 0.25


def test_hash_seeds_are_independent(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("c"), F.lit("2024-01-01").cast("date").alias("d"))
    r = df.select((hash_unit(["c"], ["d"], 1) < 0.5).cast("int").alias("a"),
                  (hash_unit(["c"], ["d"], 2) < 0.5).cast("int").alias("b")).toPandas()
    assert abs(np.corrcoef(r.a, r.b)[0, 1]) < 0.06


def test_exact_quantile_matches_numpy(spark):
    rng = np.random.default_rng(3)
    for n, q in [(1, 0.5), (2, 0.01), (231, 0.1), (5000, 0.01), (5000, 0.999)]:
        v = rng.normal(size=n)
        df = spark.createDataFrame([(float(x),) for x in v], "v double")
        assert math.isclose(exact_quantile(df, "v", q), float(np.percentile(v, 100 * q)),
                            rel_tol=0, abs_tol=1e-12)


def test_exact_quantile_with_ties(spark):
    v = [1.0] * 50 + [2.0] * 50 + [3.0]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    for q in (0.0, 0.3, 0.5, 0.99, 1.0):
        assert exact_quantile(df, "v", q) == float(np.percentile(v, 100 * q))


def test_midnight_rule(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5, 0, 0),), (dt.datetime(2024, 1, 5, 13, 0),)],
                               "ts timestamp_ntz")
    s, e = dt.date(2024, 1, 1), dt.date(2024, 1, 5)
    assert df.where(ts_in_days("ts", s, e)).count() == 2
    assert df.where(ts_in_days("ts", s, e, end_inclusive_midnight=True)).count() == 1


def test_exact_quantile_ends_on_ties(spark):
    for n in (300_000, 1_000_000):
        df = spark.range(n).select(F.when(F.col("id") % 100 == 0, F.col("id").cast("double")).otherwise(7.0).alias("v"))
        v = np.where(np.arange(n) % 100 == 0, np.arange(n), 7.0)
        for q in (0.001, 0.1, 0.995):
            assert exact_quantile(df, "v", q) == float(np.percentile(v, 100 * q))
    assert exact_quantile(spark.range(3).select(F.lit(None).cast("double").alias("v")), "v", 0.5) is None
