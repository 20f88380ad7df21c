"""Features 23-36: daily order and hit totals, and their full outer join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayguard.functions.columns import valid_customer
from dayguard.params import Params
from dayguard.schema import HIT_FEATURES, KEY_COLS, ORDER_FEATURES
from dayguard.sources.tables import Inputs


def _join_keys(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (customer, day) where NULL keys match NULL keys: both sides are
    groups of the same rows, and the NULL / 0 customer groups are kept."""
    cond = [F.col("l." + k).eqNullSafe(F.col("r." + k)) for k in KEY_COLS]
    r = right.select(*[F.col(k) for k in KEY_COLS],
                     *[F.col(c) for c in right.columns if c not in KEY_COLS])
    return left.alias("l").join(r.alias("r"), cond, how).drop(*[F.col("r." + k) for k in KEY_COLS])


def order_totals(inp: Inputs, start: dt.date, end: dt.date, p: Params,
                 valid_only: bool = False) -> DataFrame:
    """Features 23-30 per (customer, order day).

    "One-time" = not an auto-reorder and delivered; a NULL reorder flag makes
    ``NOT flag`` NULL, so such lines count as not one-time (SQL CASE rules).
    Prices are summed exactly as decimals and returned as double.

    The four distinct counts are two-level aggregations instead of Catalyst's
    Expand (which would copy every order line five times before the shuffle):
    lines -> one row per (customer, day, order) and per (customer, day,
    product) -> counts per (customer, day); the two results share the
    (customer, day) hash partitioning of their last aggregation.
    """
    ol = inp.order_line.select("customer_id", "order_id", "product_id", "order_status",
                               "order_auto_reorder_flag", "order_line_quantity",
                               "order_line_total_price",
                               F.to_date("order_placed_dttm").alias("day"))
    cond = F.col("day").between(F.lit(start), F.lit(end))
    if valid_only:
        cond = cond & valid_customer("customer_id")
    lines = ol.where(cond)
    delivered = F.col("order_status") == p.delivered_status
    onetime = F.coalesce(~F.col("order_auto_reorder_flag") & delivered, F.lit(False))
    qty, price = F.col("order_line_quantity"), F.col("order_line_total_price")
    keys = [F.col("customer_id").alias(KEY_COLS[0]), F.col("day").alias(KEY_COLS[1])]
    per_order = (lines.groupBy(*keys, "order_id")
                 .agg(F.max(onetime).alias("one"),
                      F.sum(F.when(onetime, qty).otherwise(0)).alias("q1"),
                      F.sum(F.when(delivered, qty).otherwise(0)).alias("qd"),
                      F.sum(F.when(delivered, price).otherwise(0)).alias("pd"),
                      F.sum(F.when(onetime, price).otherwise(0)).alias("p1")))
    by_order = (per_order.groupBy(*KEY_COLS)
                .agg(F.count("order_id").alias("TOTAL_NUM_ORDERS"),
                     F.count_if(F.col("one") & F.col("order_id").isNotNull())
                      .alias("NUM_ONETIME_ORDERS"),
                     F.sum("q1").cast("double").alias("ONETIME_ORDER_QUANTITY"),
                     F.sum("qd").cast("double").alias("TOTAL_ORDER_QUANTITY"),
                     F.sum("pd").cast("double").alias("TOTAL_ORDER_PRICE"),
                     F.sum("p1").cast("double").alias("ONETIME_ORDER_PRICE")))
    per_product = lines.groupBy(*keys, "product_id").agg(F.max(onetime).alias("one"))
    by_product = (per_product.groupBy(*KEY_COLS)
                  .agg(F.count("product_id").alias("DISTINCT_PRODUCT_ORDERED"),
                       F.count_if(F.col("one") & F.col("product_id").isNotNull())
                        .alias("DISTINCT_PRODUCT_ONETIME_ORDERED")))
    return _join_keys(by_order, by_product, "inner").select(
        *[F.col("l." + k).alias(k) for k in KEY_COLS], *ORDER_FEATURES)


def hit_totals(inp: Inputs, start: dt.date, end: dt.date, p: Params,
               valid_only: bool = False) -> DataFrame:
    """Features 31-36 per (customer, session day).

    TOTAL_PAGES_VIEWED is NULL (not 0) on days without page hits; a page with a
    NULL path or title is not counted in DISTINCT_PAGES_VIEWED.  Distinct
    counts are two-level aggregations (per product, per page) instead of an
    Expand of every hit.
    """
    h = inp.hits_union
    cond = F.col("ga_sessions_date").between(F.lit(start), F.lit(end))
    if valid_only:
        cond = cond & valid_customer("customer_id")
    hits = h.where(cond)
    page = F.col("type") == p.page_type
    click = F.coalesce(F.col("is_click"), F.lit(False))
    keys = [F.col("customer_id").alias(KEY_COLS[0]), F.col("ga_sessions_date").alias(KEY_COLS[1])]
    per_product = (hits.groupBy(*keys, "product_id")
                   .agg(F.count("product_id").alias("n"),
                        F.count(F.when(click, F.col("product_id"))).alias("nc"),
                        F.sum(F.when(page, F.lit(1))).alias("np")))
    by_product = (per_product.groupBy(*KEY_COLS)
                  .agg(F.count("product_id").alias("DISTINCT_PRODUCT_HIT"),
                       F.sum("n").alias("TOTAL_PRODUCT_HIT"),
                       F.count_if(F.col("nc") > 0).alias("DISTINCT_PRODUCT_CLICKED"),
                       F.sum("nc").alias("TOTAL_PRODUCT_CLICKED"),
                       F.sum("np").cast("long").alias("TOTAL_PAGES_VIEWED")))
    page_key = F.concat("page_path", F.lit(","), "page_title")
    per_page = (hits.where(page & page_key.isNotNull())
                .groupBy(*keys, page_key.alias("pk")).agg(F.count(F.lit(1)).alias("_")))
    by_page = per_page.groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("DISTINCT_PAGES_VIEWED"))
    return (_join_keys(by_product, by_page, "left")
            .select(*[F.col("l." + k).alias(k) for k in KEY_COLS], *HIT_FEATURES[:5],
                    F.coalesce("DISTINCT_PAGES_VIEWED", F.lit(0).cast("long"))
                     .alias("DISTINCT_PAGES_VIEWED")))


def basic_features(inp: Inputs, start: dt.date, end: dt.date, p: Params,
                   valid_only: bool = False, order_by_customer: bool = True) -> DataFrame:
    """Order totals FULL OUTER JOIN hit totals on (customer, day).

    Rows 23-30 are NULL on days with hits only and 31-36 on days with orders
    only.  ``valid_only=False`` keeps customer 0 / NULL like the original.
    """
    o = order_totals(inp, start, end, p, valid_only)
    h = hit_totals(inp, start, end, p, valid_only)
    j = o.alias("o").join(h.alias("h"), (F.col("o.CUSTOMER_ID") == F.col("h.CUSTOMER_ID"))
                          & (F.col("o.GA_SESSIONS_DATE") == F.col("h.GA_SESSIONS_DATE")), "full")
    out = j.select(F.coalesce("o.GA_SESSIONS_DATE", "h.GA_SESSIONS_DATE").alias("GA_SESSIONS_DATE"),
                   F.coalesce("o.CUSTOMER_ID", "h.CUSTOMER_ID").alias("CUSTOMER_ID"),
                   *[F.col("o." + c) for c in ORDER_FEATURES],
                   *[F.col("h." + c) for c in HIT_FEATURES])
    return out.orderBy("CUSTOMER_ID") if order_by_customer else out
