"""Corpus preparation: documents -> clean, distinct, redacted documents -> packed sequences.

STAGES are (name, function(spark, docs, sf_dir) -> DataFrame); each works on all its
predecessor kept, and all but the last return the columns of documents.

Defined cases: null text is kept out by the quality rules (no words); rows that share a
doc_id (or have none) are documents of their own as long as their texts differ, and rows
equal in both become one; columns may have any further names, those the stages use for
themselves included; an empty table passes through as empty. ORACLE_SQL is None:
trained models take part, so the stages are tested against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayguard.llm import packing, parity_join, pii, repetition, toxicity
from dayguard.llm.common import read_table, spool
from dayguard.llm.queries import TOKENIZERS

TOXIC_FROM = 0.3
BATCH_ROWS = 1_000  # texts that a Python task is handed at a time; they can be long


def _small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under TOXIC_FROM; learnt from all labelled rows."""
    _small_batches(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    aside = {c: _free(f"_{c}", docs.columns) for c in docs.columns if c.lower() == "tox"}
    scored = toxicity.score(docs.withColumnsRenamed(aside), model)
    return scored.where(F.col("tox.score") < TOXIC_FROM).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the suffix-array limits keep."""
    _small_batches(spark)
    q = _free("_q", docs.columns)
    return docs.where(F.col("text").isNotNull()).withColumn(
        q, repetition.stats_column(F.col("text"))).where(repetition.keeps(F.col(q))).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five-word shingles, Jaccard 0.8 or more).

    A row's number is its doc_id; rows of a doc_id that occurs more than once, or is null, are
    told apart by a hash of id and text, so each text of such an id is judged on its own.
    Of rows equal in id and text the least by the other columns stays.
    """
    _small_batches(spark)
    columns = docs.columns
    row = _free("_row", columns)
    twice = spool(docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(row)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(row))
    by_text = F.xxhash64(F.col("doc_id"), F.col("text"))
    if twice.isEmpty():
        numbered = docs.withColumn(row, F.coalesce(F.col("doc_id").cast("long"), by_text))
    else:
        again = twice.select(F.col(row).alias("doc_id"), F.lit(True).alias(row))
        numbered = docs.join(again, "doc_id", "left").withColumn(
            row, F.when(F.col("doc_id").isNull() | F.col(row), by_text).otherwise(F.col("doc_id").cast("long")))
    numbered = numbered.select(*[F.col(c) for c in columns], row)
    members, _ = parity_join.component_join(numbered, parity_join.JoinSpec(5, 80, 100), id_col=row)
    gone = members.where("doc_id <> component_id").select(F.col("doc_id").alias(row)).distinct()
    kept = numbered.join(gone, row, "left_anti")
    alone = kept.where(F.col("doc_id").isNotNull() & (F.col(row) == F.col("doc_id")))
    several = kept.where(F.col("doc_id").isNull() | (F.col(row) != F.col("doc_id")))
    least = several.groupBy(row).agg(F.min(F.struct(*columns)).alias("x")).select("x.*")
    return alone.select(*columns).unionByName(least.select(*columns))


def _free(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the new text."""
    _small_batches(spark)
    name = _free("_new", docs.columns)
    new = docs.withColumn(name, pii.redacted_column(F.col("text"), pii.fit(docs)))
    return new.select(*[F.col(name).alias(c) if c == "text" else F.length(name).cast(t).alias(c) if c == "n_chars"
                        else F.col(c) for c, t in docs.dtypes])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document and their place in the sequences."""
    _small_batches(spark)
    return packing.pack(packing.pieces(docs, f"{TOKENIZERS}/word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", one_of_each_group),
    ("personal_data", redact_personal),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
