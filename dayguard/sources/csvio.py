"""Delimited text sources and sinks with declared schemas (no inference)."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.schema import (BEHAVIOR_FEATURES, CITY_FEATURES, CLICK_FEATURES, FEATURES,
                             HIT_FEATURES, KEY_COLS, ORDER_FEATURES, PURCHASE_FEATURES)

_INT_FEATURES = set(BEHAVIOR_FEATURES) | {CITY_FEATURES[3]}
_DOUBLE_FEATURES = set(ORDER_FEATURES[4:])


def _ftype(name: str) -> T.DataType:
    if name in _INT_FEATURES:
        return T.IntegerType()
    if name in _DOUBLE_FEATURES:
        return T.DoubleType()
    return T.LongType()


FEATURE_SCHEMA = T.StructType(
    [T.StructField(KEY_COLS[0], T.LongType()), T.StructField(KEY_COLS[1], T.DateType())]
    + [T.StructField(c, _ftype(c)) for c in FEATURES])

ATO_LABEL_SCHEMA = T.StructType([T.StructField("order_id", T.LongType()),
                                 T.StructField("customer_id", T.LongType())])
FRAUD_LABEL_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in
                                   ("order_id", "fraud_flag", "fraud_return", "chargeback_flag")])

assert len(CLICK_FEATURES) == len(PURCHASE_FEATURES) == 6 and len(HIT_FEATURES) == 6


MAX_FILE_BYTES = 5_000_000_000  # fixed value: the export's file size limit


def numbered_files(df: DataFrame, max_bytes: int, null_value: str = "NaN", sep: str = ",") -> DataFrame:
    """``df`` with a ``file`` column (task-number): rows of one value, written as CSV with a
    header, take ``max_bytes`` bytes at most (a row that is larger alone is a file alone).

    A row's bytes are those of the text the writer makes of it; each task runs through its
    rows and opens a new file where the next row would not fit, without a shuffle.
    """
    options = {"sep": sep, "nullValue": null_value, "dateFormat": "yyyy-MM-dd"}
    size = F.octet_length(F.to_csv(F.struct(*[F.col(c) for c in df.columns]), options)) + 1
    room = max_bytes - len(sep.join(df.columns).encode()) - 1

    def run(batches):
        from pyspark import TaskContext
        task, number, used = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            sizes = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            upto, files, at = np.cumsum(sizes), np.empty(len(sizes), dtype=np.int64), 0
            while at < len(sizes):
                before = upto[at - 1] if at else 0
                end = max(at, int(np.searchsorted(upto, before + room - used, side="right")))
                if end == at:  # the next row does not fit
                    if used:
                        number, used = number + 1, 0
                        continue
                    end = at + 1
                files[at:end] = number
                used += int(upto[end - 1] - before)
                at = end
            names = pa.array([f"{task:06d}-{n:06d}" for n in files.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], names], names=[*b.schema.names[:-1], "file"])

    schema = T.StructType([*df.schema.fields, T.StructField("file", T.StringType())])
    return df.withColumn("_bytes", size.cast("long")).mapInArrow(run, schema)


def write_csv(df: DataFrame, path: str, *, single_file: bool = False,
              max_records_per_file: int | None = None, max_bytes_per_file: int | None = None,
              null_value: str = "NaN", sep: str = ",", compression: str | None = None) -> str:
    """Export with a header; NULL is written as ``null_value``.

    ``single_file`` sends the result rows (and only them) to one writing task by an
    exchange, so the plan below stays parallel: use it only for small labelled sets.  Large exports stay parallel, one or more
    files per task, capped at ``max_records_per_file`` rows or ``max_bytes_per_file`` bytes
    (before compression) each; the latter are one folder ``file=...`` per file.
    """
    out = df.repartition(1) if single_file else df
    if max_bytes_per_file:
        out = numbered_files(out, max_bytes_per_file, null_value, sep)
    w = (out.write.mode("overwrite").option("header", True).option("nullValue", null_value)
         .option("sep", sep).option("dateFormat", "yyyy-MM-dd"))
    if max_bytes_per_file:
        w = w.partitionBy("file")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType, *,
             sep: str = ",", header: bool = True, null_value: str = "NaN",
             tolerant: bool = False, spread: bool = False) -> DataFrame:
    """Declared-schema read of one or many files (gzip is read transparently).

    A malformed row stops the read, as it would otherwise turn into NULLs and then zeros.
    ``tolerant`` (label files): a row with too many fields keeps the first ones, a row
    with too few gets NULLs, as a column-count-tolerant warehouse load does
    (:func:`read_with_rejects` also says which rows those are).

    ``spread`` deals the rows out evenly after the read: a gzip file is one task, so what
    follows would run on as many tasks as there are files.
    """
    df = (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("nullValue", null_value).option("mode", "PERMISSIVE" if tolerant else "FAILFAST")
            .option("dateFormat", "yyyy-MM-dd").csv(paths)).select(*schema.names)
    return df.hint("rebalance") if spread else df


REJECT_COLS = ["file", "record", "reason", "action"]


def read_with_rejects(spark: SparkSession, paths: str | list[str], schema: T.StructType, *, sep: str = "\t",
                      header: bool = True, null_value: str = "NaN", required: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a tolerant read.

    rejects: file, record text, reason and action of every line that did not fit the schema.
    ``mended`` lines are among the rows: ``extra fields`` (the first ones are kept) and
    ``missing fields`` (the rest is NULL). ``dropped`` lines are not: ``bad value`` (a field
    that is not of its type) and ``no <column>`` (a column of ``required`` that is NULL; its
    record is written anew from the fields, NULL as nothing).
    Rows and dropped lines together are all lines.
    """
    broken = "_broken"
    wide = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    df = (spark.read.schema(wide).option("header", header).option("sep", sep).option("nullValue", null_value)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken).option("dateFormat", "yyyy-MM-dd")
          .csv(paths).withColumn("file", F.col("_metadata.file_path")))
    fields = F.split(broken, re.escape(sep), -1)
    bad = F.lit(False)
    for i, f in enumerate(schema.fields):
        given = F.try_element_at(fields, F.lit(i + 1))
        bad = bad | (F.col(f.name).isNull() & given.isNotNull() & ~given.isin("", null_value))
    n = len(schema.fields)
    reason = (F.when(F.col(broken).isNotNull() & bad, "bad value")
              .when(F.size(fields) < n, "missing fields").when(F.size(fields) > n, "extra fields"))
    missing = F.lit(None).cast("string")
    for c in reversed(required):
        missing = F.when(F.col(c).isNull(), F.lit(f"no {c}")).otherwise(missing)
    reason = F.when(reason == "bad value", reason).otherwise(F.coalesce(missing, reason))
    drop = (F.col("reason") == "bad value") | F.col("reason").startswith("no ")
    judged = df.withColumn("reason", reason)
    whole = F.coalesce(F.col(broken), F.to_csv(F.struct(*schema.names), {"sep": sep, "nullValue": "", "dateFormat": "yyyy-MM-dd"}))
    rejects = judged.where("reason IS NOT NULL").select(
        "file", whole.alias("record"), "reason", F.when(drop, "dropped").otherwise("mended").alias("action"))
    return judged.where(~F.coalesce(drop, F.lit(False))).select(*schema.names), rejects
