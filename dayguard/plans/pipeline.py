"""End-to-end plans: features -> labels -> prepared frames -> scores."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.operators import assemble, labels, prep
from dayguard.operators.evaluate import mean_square_score
from dayguard.params import Params
from dayguard.schema import FEATURES, KEY_COLS
from dayguard.session import ensure_checkpoint_dir, stored
from dayguard.sources.tables import Inputs

SAMPLE_FRAC = 0.2
VAL_FRAC = 0.05


@dataclass
class Labelled:
    ato_days: DataFrame      # customer_id, date, order_id
    all_days: DataFrame
    ato_keys: DataFrame      # CUSTOMER_ID, GA_SESSIONS_DATE
    all_keys: DataFrame


def labelled_days(inp: Inputs, p: Params) -> Labelled:
    ato = labels.label_days(labels.label_orders(inp.ato_orders, inp.orders, p, "label"))
    allf = labels.label_days(labels.label_orders(inp.fraud_orders, inp.orders, p, "orders"))
    return Labelled(ato, allf, labels.day_keys(ato), labels.day_keys(allf))


def in_training(df: DataFrame, p: Params) -> DataFrame:
    return df.where(F.col(KEY_COLS[1]).between(F.lit(p.feature_start), F.lit(p.train_end)))


def in_test(df: DataFrame, p: Params) -> DataFrame:
    return df.where(F.col(KEY_COLS[1]) > F.lit(p.train_end))


def normal_rows(ft: DataFrame, lab: Labelled, p: Params,
                frac: float = SAMPLE_FRAC) -> DataFrame:
    """Training-period rows: filled, sampled, without any labelled day."""
    filled = prep.fill_nulls(in_training(ft, p))
    sampled = prep.sample_rows(filled, frac)
    return prep.remove_labelled(sampled, lab.all_keys, lab.ato_keys)


def split_normal(ft: DataFrame, lab: Labelled, p: Params, frac: float = SAMPLE_FRAC,
                 val_frac: float = VAL_FRAC) -> DataFrame:
    return prep.with_split(stored(normal_rows(ft, lab, p, frac), "normal"), val_frac)


def fraud_sets(ft: DataFrame, lab: Labelled) -> tuple[DataFrame, DataFrame]:
    """(ATO rows, all-fraud rows), filled; rows that repeat with their keys count once."""
    ato = prep.fill_nulls(labels.labelled_rows(ft, lab.ato_days)).dropDuplicates()
    allf = prep.fill_nulls(labels.labelled_rows(ft, lab.all_days))
    return ato, allf


def distinct_features(rows: DataFrame) -> DataFrame:
    """Feature rows with the keys dropped, each once: the set as preparation scores it."""
    return rows.drop(*KEY_COLS).dropDuplicates()


@dataclass
class Prepared:
    scaler: prep.Scaler
    train: DataFrame         # standardised
    val: DataFrame
    ato: DataFrame
    allf: DataFrame
    test_normal: DataFrame   # test-period rows without labelled days, standardised


def prepare(inp: Inputs, p: Params, ft: DataFrame | None = None,
            materialise: bool = True, frac: float = SAMPLE_FRAC, val_frac: float = VAL_FRAC) -> Prepared:
    """Fill, sample (``frac`` 1.0 trains on every row), remove labelled days, split, fit the scaler, standardise.

    The split normal rows and the two fraud sets are written once as Parquet in the
    shared folder (``materialise``): the scaler fit, every model and every evaluation read
    the columns they need of them, and short plans keep the optimizer
    cheap.  The test period stays lazy (scored once).
    """
    ft = ft if ft is not None else assemble.feature_table(inp, p)
    lab = labelled_days(inp, p)
    if materialise:
        # fraud days are read six times below (semi and anti joins); write them once
        ato_d, all_d = stored(lab.ato_days), stored(lab.all_days)
        lab = Labelled(ato_d, all_d, labels.day_keys(ato_d), labels.day_keys(all_d))
    split = split_normal(ft, lab, p, frac, val_frac)
    ato, allf = fraud_sets(ft, lab)
    if materialise:
        split, ato, allf = stored(split), stored(ato), stored(allf)
    train = split.where(F.col("split") == "train").drop("split")
    val = split.where(F.col("split") == "val").drop("split")
    scaler = prep.Scaler.fit(train)
    test = prep.remove_labelled(prep.fill_nulls(in_test(ft, p)), lab.all_keys, lab.ato_keys)
    t = scaler.transform
    return Prepared(scaler, t(train), t(val), t(ato), t(allf), t(test))


def written(ft: DataFrame) -> DataFrame:
    """The feature table as Parquet by month in the shared folder, read with directory and
    column pruning and the day filter pushed to the files."""
    path = f"{ensure_checkpoint_dir(ft.sparkSession).rstrip('/')}/features-{uuid.uuid4().hex}"
    month = F.date_format(KEY_COLS[1], "yyyy-MM")
    ft.withColumn("month", month).write.partitionBy("month").parquet(path)
    return ft.sparkSession.read.parquet(path).drop("month")


def with_baseline_score(df: DataFrame) -> DataFrame:
    return df.withColumn("score", mean_square_score(FEATURES))


def export_job(inp: Inputs, p: Params, out_dir: str, max_records_per_file: int | None = None,
               max_bytes_per_file: int | None = None) -> dict:
    """The feature job's exports, as the original job writes them.

    * ``features/``: the feature table as CSV (header, NULL as ``NaN``), split by
      ``month=yyyy-MM`` directories so a monthly reader prunes to its period, no file
      over ``max_bytes_per_file`` bytes (the original job's limit by default), nor over
      ``max_records_per_file`` rows if given;
    * ``ato_rows/`` and ``fraud_rows/``: the labelled sets, one file each.

    The feature table is computed once (checkpoint) and read by all three writes.
    """
    from dayguard.sources.csvio import MAX_FILE_BYTES, numbered_files, write_csv

    ft = written(assemble.feature_table(inp, p))
    lab = labelled_days(inp, p)
    base = out_dir.rstrip("/")
    # no shuffle by month (a month would land in one task): every task writes
    # its own capped files into each month directory it holds rows for
    (numbered_files(ft.select(*KEY_COLS, *FEATURES), max_bytes_per_file or MAX_FILE_BYTES)
       .withColumn("month", F.date_format(KEY_COLS[1], "yyyy-MM"))
       .write.mode("overwrite").partitionBy("month", "file")
       .option("header", True).option("nullValue", "NaN").option("dateFormat", "yyyy-MM-dd")
       .option("maxRecordsPerFile", int(max_records_per_file or 0))
       .csv(f"{base}/features"))
    write_csv(labels.labelled_rows(ft, lab.ato_days), f"{base}/ato_rows", single_file=True)
    write_csv(labels.labelled_rows(ft, lab.all_days), f"{base}/fraud_rows", single_file=True)
    return {"features": f"{base}/features", "ato_rows": f"{base}/ato_rows",
            "fraud_rows": f"{base}/fraud_rows"}


def read_feature_months(spark, path: str, months: list[str] | None = None) -> DataFrame:
    """Read exported features (declared schema); ``months`` prunes directories."""
    from dayguard.sources.csvio import FEATURE_SCHEMA
    schema = T.StructType(FEATURE_SCHEMA.fields + [T.StructField("month", T.StringType()), T.StructField("file", T.StringType())])
    df = (spark.read.schema(schema).option("header", True).option("nullValue", "NaN")
          .option("mode", "FAILFAST").option("dateFormat", "yyyy-MM-dd").csv(path))
    if months:
        df = df.where(F.col("month").isin(months))
    return df.drop("month", "file")
