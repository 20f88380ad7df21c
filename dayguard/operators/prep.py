"""Training-data preparation: fill, sample, remove known fraud, split, scale."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayguard.functions.selection import mark_smallest, share_of
from dayguard.schema import FEATURES, KEY_COLS

SAMPLE_SEED = 42
SPLIT_SEED = 4242


def union_periods(frames: list[DataFrame]) -> DataFrame:
    """Stack period frames (UNION ALL by column name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def fill_nulls(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """Missing feature values become 0 (numeric columns only)."""
    return df.fillna(0, subset=list(cols))


def null_profile(df: DataFrame) -> DataFrame:
    """Non-null count of every column, one row."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def sample_rows(df: DataFrame, frac: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """Exactly ceil(n x ``frac``) rows: those with the smallest hash of (customer, day) and
    the seed, independent of partitioning and retries. Counts the rows when it is called."""
    return mark_smallest(df, share_of(df.count(), frac), KEY_COLS, seed).where("picked").drop("picked")


def remove_labelled(df: DataFrame, *day_keys: DataFrame) -> DataFrame:
    """Anti-join on (CUSTOMER_ID, GA_SESSIONS_DATE) with every labelled key set."""
    for k in day_keys:
        df = df.join(k, KEY_COLS, "left_anti")
    return df


def with_split(df: DataFrame, val_frac: float, seed: int = SPLIT_SEED) -> DataFrame:
    """Adds ``split`` = 'val' for exactly ceil(n x ``val_frac``) of the rows, else 'train'."""
    marked = mark_smallest(df, share_of(df.count(), val_frac), KEY_COLS, seed)
    return marked.withColumn("split", F.when(F.col("picked"), "val").otherwise("train")).drop("picked")


@dataclass(frozen=True)
class Scaler:
    """Standard scaler (population std; a constant column is divided by 1)."""

    cols: tuple
    mean: tuple
    std: tuple

    @staticmethod
    def fit(df: DataFrame, cols: list[str] = FEATURES) -> "Scaler":
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        n = len(cols)
        mean = tuple(float(row[f"m{i}"] or 0.0) for i in range(n))
        std = tuple(float(row[f"s{i}"] or 0.0) for i in range(n))
        return Scaler(tuple(cols), mean, std)

    @property
    def scale(self) -> tuple:
        return tuple(s if s != 0 else 1.0 for s in self.std)

    def transform(self, df: DataFrame) -> DataFrame:
        z = {c: ((F.col(c) - F.lit(m)) / F.lit(s)).alias(c)
             for c, m, s in zip(self.cols, self.mean, self.scale)}
        return df.select(*[z.get(c, F.col(c)) for c in df.columns])

    def params_frame(self, spark) -> DataFrame:
        rows = list(zip(self.cols, self.mean, self.std))
        return spark.createDataFrame(rows, "feature string, mean double, std double")


def scaler_params(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """Lazy (feature, mean, std) table of a scaler fit (one aggregation pass)."""
    stats = F.array(*[F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"),
                               F.stddev_pop(c).alias("std")) for c in cols])
    return df.agg(stats.alias("s")).select(F.inline("s"))
