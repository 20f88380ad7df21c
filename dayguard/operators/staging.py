"""The four staging tables of the feature job, plus the session days.

Each is a filtered projection of one input; filters on the input columns are
pushed into the scan.  ``customer_id`` and ``day`` are the common keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.functions.columns import days_between, ts_in_days, valid_customer
from dayguard.params import Params
from dayguard.sources.tables import Inputs


def session_days(inp: Inputs, p: Params) -> DataFrame:
    """Session rows on feature days (one row per session; not distinct)."""
    return (inp.ga_sessions
            .where(days_between("ga_sessions_date", p.feature_start, p.feature_end)
                   & valid_customer("customer_id"))
            .select("customer_id", F.col("ga_sessions_date").alias("day")))


def geo_city(df: DataFrame, col: str = "geo_network") -> Column:
    """The ``city`` field of the session's geo record, as text: JSON text,
    a struct, or a semi-structured VARIANT value."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StructType):
        return F.col(col).getField("city").cast("string")
    if isinstance(dtype, T.VariantType):
        return F.variant_get(F.col(col), "$.city", "string")
    return F.get_json_object(col, "$.city")


def city_info(inp: Inputs, p: Params) -> DataFrame:
    """customer_id, day, city over the history window."""
    return (inp.ga_sessions
            .where(days_between("ga_sessions_date", p.history_start, p.history_end)
                   & valid_customer("customer_id"))
            .select("customer_id", F.col("ga_sessions_date").alias("day"),
                    geo_city(inp.ga_sessions).alias("city")))


def product_click(inp: Inputs, p: Params) -> DataFrame:
    """Product clicks over the history window."""
    return (inp.hits_products
            .where(days_between("ga_sessions_date", p.history_start, p.history_end)
                   & (F.col("event_action") == p.click_action)
                   & valid_customer("customer_id"))
            .select("customer_id", F.col("ga_sessions_date").alias("day"), "product_id",
                    F.col("product_category_level1").alias("level1"),
                    F.col("product_category_level2").alias("level2")))


def order_info(inp: Inputs, p: Params, distinct: bool = False) -> DataFrame:
    """Ordered products with their categories over the history window.

    ``distinct=True`` reduces order lines to distinct (customer, day, product)
    *before* the product dimension join, which is all the distinct counts need.
    """
    lines = (inp.order_line
             .where(ts_in_days("order_placed_dttm", p.history_start, p.history_end,
                               p.end_inclusive_midnight)
                    & F.col("product_id").isNotNull() & valid_customer("customer_id"))
             .select("customer_id", F.to_date("order_placed_dttm").alias("day"), "product_id"))
    if distinct:
        lines = lines.distinct()
    prod = inp.product.select("product_id", F.col("category_level1").alias("level1"),
                              F.col("category_level2").alias("level2"))
    return lines.join(prod, "product_id", "left").select(
        "customer_id", "day", "product_id", "level1", "level2")


def ga_behavior(inp: Inputs, p: Params) -> DataFrame:
    """Interaction hits over the history window."""
    return (inp.hits_union
            .where(valid_customer("customer_id")
                   & days_between("ga_sessions_date", p.history_start, p.history_end)
                   & F.col("is_interaction"))
            .select("customer_id", F.col("ga_sessions_date").alias("day"),
                    "event_category", "event_label", "event_action", "list_category"))
