"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from dayguard.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spool(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint`` but keeps column pruning and statistics, so
    a lost executor costs only the tasks that re-read the files.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/spool-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokenizer_file(path: str) -> str:
    """The public tokenizer file of this name where the executor has it, else ``path`` itself."""
    try:
        from public_tokenizers import path as installed
        found = Path(str(installed(Path(path).name)))
    except (ImportError, KeyError, ValueError, FileNotFoundError):
        return path
    return str(found) if found.exists() else path


class Scratch:
    """Spooled tables that can be removed once everything made of them is spooled itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{ensure_checkpoint_dir(spark)}/spool-{uuid.uuid4().hex}"

    def spool(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def runs_of(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive items into runs whose sizes sum to about ``most`` (one item at least)."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def slices(batches, text_at: int, most_bytes: int = 4 << 20, most_rows: int = 400):
    """Arrow batches cut into slices of bounded text (one row at least)."""
    for batch in batches:
        sizes = [n or 0 for n in pc.binary_length(batch.column(text_at)).to_pylist()]
        for lo, hi in runs_of(sizes, most_bytes):
            for at in range(lo, hi, most_rows):
                yield batch.slice(at, min(hi, at + most_rows) - at)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (public splitmix64 constants); uint64 in, uint64 out."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
