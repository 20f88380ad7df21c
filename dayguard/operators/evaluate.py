"""Evaluation of anomaly scores and -1/+1 predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayguard.schema import FEATURES, KEY_COLS
from dayguard.sources.parts import Store, content_digest


def mean_square_score(cols: list[str] = FEATURES) -> Column:
    """Reconstruction loss of the model that predicts the training mean:
    mean of squared standardised features (a deterministic baseline score)."""
    return sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0)) / F.lit(float(len(cols)))


def scored_labels(normal: DataFrame, fraud: DataFrame, score: str = "score") -> DataFrame:
    """Stack normal rows (label 0) and fraud rows (label 1) with their score."""
    cols = [*KEY_COLS, score]
    return (normal.select(*cols, F.lit(0).alias("label"))
            .unionByName(fraud.select(*cols, F.lit(1).alias("label"))))


def period_of(day: str, period: str) -> Column:
    if period == "day":
        return F.col(day)
    return F.trunc(day, {"week": "week", "month": "month"}[period])


def period_confusion(scored: DataFrame, threshold: float, period: str,
                     day: str = KEY_COLS[1], score: str = "score") -> DataFrame:
    """Per period: normal rows and false positives, fraud rows and true positives
    at ``score >= threshold`` (one aggregation, every period at once)."""
    flagged = F.col(score) >= F.lit(threshold)
    normal, fraud = F.col("label") == 0, F.col("label") == 1
    return (scored.groupBy(period_of(day, period).alias("period"))
            .agg(F.count_if(normal).alias("n_normal"),
                 F.count_if(normal & flagged).alias("fp"),
                 F.count_if(fraud).alias("n_fraud"),
                 F.count_if(fraud & flagged).alias("tp")))


def store_scores(store: Store, batch: str, scored: DataFrame, period: str, day: str = KEY_COLS[1]) -> Store:
    """Put a batch of scored rows (whole periods) into the store, replacing those periods.

    Each period is one part behind the store's manifest: a run that is killed leaves the old
    scores, a batch that is in already changes nothing, and a period that is scored anew
    under another batch name replaces its rows once."""
    digest = content_digest(scored)
    if store.known(batch, digest):
        return store
    parts = store.write("scores", scored.withColumn("part", period_of(day, period).cast("string")))
    return store.commit(parts, batch, digest)


def outlier_rates(predicted: DataFrame, dataset: str = "dataset",
                  pred: str = "pred") -> DataFrame:
    """Per dataset: rows, rows predicted -1 (outlier), and their share.

    On normal validation rows the share is the false positive rate; on fraud
    rows it is the recall."""
    return (predicted.groupBy(dataset)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col(pred) == -1).alias("n_outliers"))
            .withColumn("outlier_rate", F.col("n_outliers") / F.col("n_rows")))
