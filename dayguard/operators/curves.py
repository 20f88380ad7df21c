"""Threshold curves over (label, score) rows: ROC, PR, F1, AUC, AP.

All curves need cumulative positive / negative counts from the highest score
down.  A window ordered over the whole table would run in one task; instead:

1. ``groupBy(score)`` (ties grouped; map-side partial counts),
2. buckets of distinct scores from approximate quantiles (a bounded list of
   split points, fetched once),
3. per-bucket totals (one row per bucket, bounded) -> offsets by a tiny window,
4. a running sum inside each bucket (``partitionBy(bucket)``) plus its offset.

Results are exact; the quantiles only balance the buckets.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayguard.session import cut_lineage


def cumulative_counts(scored: DataFrame, score: str = "score", label: str = "label",
                      n_buckets: int | None = None, rel_err: float = 1e-3,
                      materialise: bool = True) -> DataFrame:
    """One row per distinct score: bucket, score, pos, neg, tp, fp (counts at
    >= score), P, N.

    The per-score counts are written once to the checkpoint folder
    (``materialise``): the quantile pass, the bucket totals and every curve
    read them, and the scoring plan is not re-expanded for each use.
    """
    spark = scored.sparkSession
    g = (scored.groupBy(F.col(score).alias("score"))
         .agg(F.count_if(F.col(label) == 1).alias("pos"),
              F.count_if(F.col(label) != 1).alias("neg")))
    if materialise:
        g = cut_lineage(g)
    if n_buckets is None:
        n_buckets = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = sorted(set(x for x in g.approxQuantile("score", probs, rel_err) if x == x))
    splits = [float("-inf")] + cuts + [float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    b = Bucketizer(splits=splits, inputCol="score", outputCol="bucket",
                   handleInvalid="keep").transform(g)
    totals = b.groupBy("bucket").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("op"),
        F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("on"),
        F.sum("bp").over(whole).alias("P"), F.sum("bn").over(whole).alias("N"))
    # offsets has one row per bucket: bounded by n_buckets, safe to broadcast
    j = b.join(F.broadcast(offsets), "bucket")
    w = (Window.partitionBy("bucket").orderBy(F.desc("score"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return j.select("bucket", "score", "pos", "neg",
                    (F.sum("pos").over(w) + F.col("op")).alias("tp"),
                    (F.sum("neg").over(w) + F.col("on")).alias("fp"),
                    F.col("P").cast("long").alias("P"), F.col("N").cast("long").alias("N"))


def _with_next(cum: DataFrame) -> DataFrame:
    """Adds the (pos, neg) of the next lower distinct score (NULL for the last).

    Inside a bucket this is ``lead``; at a bucket's last row it is the first
    row of the next non-empty lower bucket, taken from a table with one row
    per bucket (bounded, broadcast)."""
    firsts = cum.groupBy("bucket").agg(F.max_by(F.struct("pos", "neg"), "score").alias("f"))
    below = Window.orderBy("bucket")
    edges = firsts.select("bucket", F.lag("f").over(below).alias("edge"))
    w = Window.partitionBy("bucket").orderBy(F.desc("score"))
    j = cum.join(F.broadcast(edges), "bucket")
    return j.select(*cum.columns,
                    F.coalesce(F.lead("pos").over(w), F.col("edge.pos")).alias("next_pos"),
                    F.coalesce(F.lead("neg").over(w), F.col("edge.neg")).alias("next_neg"))


def roc_curve(cum: DataFrame, drop_intermediate: bool = False) -> DataFrame:
    """threshold, fpr, tpr per distinct score.

    ``drop_intermediate=True`` keeps, like the usual library default, only the
    first and last points and those where the curve changes direction (the
    increments to the next point differ), and adds the (0, 0) start point with
    a NULL threshold.
    """
    pts = cum
    if drop_intermediate:
        n = _with_next(cum)
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        keep = (first | F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos"))
                | (F.col("next_neg") != F.col("neg")))
        pts = n.where(keep)
    out = pts.select(F.col("score").alias("threshold"),
                     F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                     F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))
    if drop_intermediate:
        start = cum.agg(F.count(F.lit(1)).alias("_n")).select(
            F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
            F.lit(0.0).alias("tpr"))
        out = out.unionByName(start)
    return out


def auc(cum: DataFrame) -> DataFrame:
    """Trapezoid area under the ROC curve from (0, 0): one aggregation."""
    area = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")) / 2.0)
    return cum.agg(F.try_divide(area, F.first("P") * F.first("N")).alias("auc"))


def pr_curve(cum: DataFrame) -> DataFrame:
    """threshold, precision, recall per distinct score, plus the end point
    (precision 1, recall 0, threshold NULL) that closes the curve."""
    pts = cum.select(F.col("score").alias("threshold"),
                     F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     F.try_divide(F.col("tp"), F.col("P")).alias("recall"))
    end = cum.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def f1_curve(cum: DataFrame) -> DataFrame:
    """threshold, f1 = 2PR/(P+R); NULL where precision and recall are both 0."""
    p = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    r = F.try_divide(F.col("tp"), F.col("P"))
    return cum.select(F.col("score").alias("threshold"),
                      F.try_divide(2 * p * r, p + r).alias("f1"))


def average_precision(cum: DataFrame) -> DataFrame:
    """sum over thresholds of (recall step) * precision."""
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    return cum.agg(F.try_divide(F.sum(F.col("pos") * prec), F.first("P")).alias("average_precision"))
