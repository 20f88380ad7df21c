"""Fraud labels: order ids -> labelled customer-days -> labelled feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayguard.functions.columns import ts_in_days
from dayguard.params import Params
from dayguard.schema import KEY_COLS


def label_orders(label_ids: DataFrame, orders: DataFrame, p: Params,
                 customer_from: str = "label") -> DataFrame:
    """order_id, customer_id, date of labelled orders placed in the label window.

    ``customer_from='label'`` takes the customer from the label file (ATO file),
    ``'orders'`` from the orders table (all-fraud file has no customer).
    """
    o = (orders.where(ts_in_days("order_placed_dttm", p.label_start, p.label_end,
                                 p.end_inclusive_midnight))
         .select("order_id", F.col("customer_id").alias("o_customer_id"),
                 F.to_date("order_placed_dttm").alias("date")))
    lab = label_ids.select("order_id", *(["customer_id"] if customer_from == "label" else []))
    j = lab.join(o, "order_id")
    cust = F.col("customer_id") if customer_from == "label" else F.col("o_customer_id")
    return j.select("order_id", cust.alias("customer_id"), "date")


def label_days(labelled_orders: DataFrame) -> DataFrame:
    """One row per labelled (customer_id, date), keeping the largest order id."""
    return labelled_orders.groupBy("customer_id", "date").agg(F.max("order_id").alias("order_id"))


def day_keys(days: DataFrame) -> DataFrame:
    return days.select(F.col("customer_id").alias(KEY_COLS[0]), F.col("date").alias(KEY_COLS[1]))


def labelled_rows(features: DataFrame, days: DataFrame) -> DataFrame:
    """Feature rows of labelled days (semi join: label days are unique per key)."""
    return features.join(day_keys(days), KEY_COLS, "left_semi")
