"""Adapter from the driver's test tables to the reference's input schemas.

The production inputs (order lines, orders, product dimension, web sessions,
product hits, label files) are private; the driver's TPC-H-like tables stand in
for them by the rules below.  The same rules exist twice: as DataFrame code
(what the engine runs) and as DuckDB SQL (what the oracles run).

Fixed values of the mapping: orders are folded onto January 2024 by
``2024-01-01 + (days since 1995-01-01) % 30``; ``k`` is the integer in
``events.props``; ATO orders are ``o_orderkey % 7 = 0``, all-fraud orders
``o_orderkey % 5 = 0``; ``order_auto_reorder_flag`` is NULL when
``l_orderkey % 41 = 0``; product level 2 is NULL when ``p_partkey % 19 = 0``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayguard.sources.tables import Inputs, read_table

FOLD_ORIGIN = dt.date(1995, 1, 1)
FOLD_START = dt.date(2024, 1, 1)
FOLD_DAYS = 30


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def folded_day(c: str) -> Column:
    return F.date_add(F.lit(FOLD_START),
                      F.pmod(F.datediff(F.to_date(c), F.lit(FOLD_ORIGIN)), F.lit(FOLD_DAYS)))


def _product(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category_level1"),
        F.when(F.col("p_partkey") % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_brand")).alias("category_level2"))


def _event_action() -> Column:
    k = F.col("k")
    signup = (F.when(k % 5 == 0, "clicked add")
               .when(k % 5 == 1, "gift-card-applied")
               .when(k % 5 == 2, "add-payment-method")
               .when(k % 5 == 3, "autoship-change-frequency-increment")
               .otherwise("ship-now"))
    return (F.when(F.col("event_type") == "click", F.lit("productClick"))
             .when(F.col("event_type") == "signup", signup))


def load_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    part = read_table(spark, sf_dir, "part")  # dimension: joined by broadcast
    events = read_table(spark, sf_dir, "events")

    o = orders.select("o_orderkey", "o_custkey",
                      folded_day("o_orderdate").cast("timestamp_ntz").alias("order_placed_dttm"))
    order_line = (lineitem.join(o, lineitem.l_orderkey == o.o_orderkey)
                  .select(F.col("o_custkey").alias("customer_id"),
                          F.col("o_orderkey").alias("order_id"),
                          F.col("l_partkey").alias("product_id"),
                          "order_placed_dttm",
                          F.when(F.col("l_linestatus") == "F", "D").otherwise("X").alias("order_status"),
                          F.when(F.col("l_orderkey") % 41 == 0, F.lit(None).cast("boolean"))
                           .otherwise(F.col("l_returnflag") == "A").alias("order_auto_reorder_flag"),
                          F.col("l_quantity").alias("order_line_quantity"),
                          F.col("l_extendedprice").cast("decimal(18,2)").alias("order_line_total_price")))
    orders_src = o.select(F.col("o_orderkey").alias("order_id"),
                          F.col("o_custkey").alias("customer_id"), "order_placed_dttm")
    product = _product(part)

    ev = events.select(F.col("user_id").alias("customer_id"),
                       F.to_date("ts").alias("ga_sessions_date"), "event_type", _k().alias("k"))
    k = F.col("k")
    city = (F.when(k % 10 == 0, F.lit("(not set)"))
             .when(k % 17 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("city"), (k % 10).cast("string"))))
    ga_sessions = ev.select("customer_id", "ga_sessions_date",
                            F.to_json(F.struct(city.alias("city"))).alias("geo_network"))

    hits_products = (ev.join(product, ev.k == product.product_id, "left")
                     .select("customer_id", "ga_sessions_date",
                             F.col("k").alias("product_id"),
                             F.col("category_level1").alias("product_category_level1"),
                             F.col("category_level2").alias("product_category_level2"),
                             _event_action().alias("event_action")))
    action = _event_action()
    hits_union = ev.select(
        "customer_id", "ga_sessions_date", F.col("k").alias("product_id"),
        (F.col("event_type") == "click").alias("is_click"),
        F.when(F.col("event_type") == "view", "PAGE").otherwise("EVENT").alias("type"),
        F.concat(F.lit("/p/"), k.cast("string")).alias("page_path"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("title"), (k % 7).cast("string"))).alias("page_title"),
        F.when((F.col("event_type") == "signup") & (k % 5 == 0), "address book").alias("event_category"),
        F.when((action == "ship-now") & (k % 2 == 0), "done").otherwise("start").alias("event_label"),
        action.alias("event_action"),
        F.when((F.col("event_type") == "error") & (k % 4 == 0), "reset-password").alias("list_category"),
        (F.col("event_type") != "view").alias("is_interaction"))

    ato_orders = orders.where(F.col("o_orderkey") % 7 == 0).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    fraud_orders = orders.where(F.col("o_orderkey") % 5 == 0).select(
        F.col("o_orderkey").alias("order_id"), F.lit(1).cast("long").alias("fraud_flag"),
        F.lit(0).cast("long").alias("fraud_return"), F.lit(0).cast("long").alias("chargeback_flag"))
    return Inputs(order_line=order_line, orders=orders_src, product=product,
                  ga_sessions=ga_sessions, hits_products=hits_products, hits_union=hits_union,
                  ato_orders=ato_orders, fraud_orders=fraud_orders)


# --- the same mapping as DuckDB SQL (used by the oracles only) -----------------
_FOLD = ("CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', "
         "CAST({c} AS DATE)) % 30 AS INTEGER) AS TIMESTAMP)")

SQL_VIEWS = {
    "m_order_line": f"""
      SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_id, l.l_partkey AS product_id,
             {_FOLD.format(c='o.o_orderdate')} AS order_placed_dttm,
             CASE WHEN l.l_linestatus = 'F' THEN 'D' ELSE 'X' END AS order_status,
             CASE WHEN l.l_orderkey % 41 = 0 THEN NULL ELSE l.l_returnflag = 'A' END
               AS order_auto_reorder_flag,
             l.l_quantity AS order_line_quantity,
             CAST(l.l_extendedprice AS DECIMAL(18,2)) AS order_line_total_price
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "m_orders": f"""
      SELECT o_orderkey AS order_id, o_custkey AS customer_id,
             {_FOLD.format(c='o_orderdate')} AS order_placed_dttm
      FROM orders""",
    "m_product": """
      SELECT p_partkey AS product_id, p_type AS category_level1,
             CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_brand END AS category_level2
      FROM part""",
    "m_ev": """
      SELECT user_id AS customer_id, CAST(ts AS DATE) AS ga_sessions_date, event_type,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
      FROM events""",
    "m_ev2": """
      SELECT *,
             CASE WHEN event_type = 'click' THEN 'productClick'
                  WHEN event_type = 'signup' THEN
                    CASE k % 5 WHEN 0 THEN 'clicked add' WHEN 1 THEN 'gift-card-applied'
                               WHEN 2 THEN 'add-payment-method'
                               WHEN 3 THEN 'autoship-change-frequency-increment'
                               ELSE 'ship-now' END
             END AS event_action
      FROM m_ev""",
    "m_ga_sessions": """
      SELECT customer_id, ga_sessions_date,
             CASE WHEN k % 10 = 0 THEN '(not set)' WHEN k % 17 = 0 THEN NULL
                  ELSE 'city' || CAST(k % 10 AS VARCHAR) END AS city
      FROM m_ev""",
    "m_hits_products": """
      SELECT e.customer_id, e.ga_sessions_date, e.k AS product_id,
             p.category_level1 AS product_category_level1,
             p.category_level2 AS product_category_level2, e.event_action
      FROM m_ev2 e LEFT JOIN m_product p ON e.k = p.product_id""",
    "m_hits_union": """
      SELECT customer_id, ga_sessions_date, k AS product_id,
             event_type = 'click' AS is_click,
             CASE WHEN event_type = 'view' THEN 'PAGE' ELSE 'EVENT' END AS type,
             '/p/' || CAST(k AS VARCHAR) AS page_path,
             CASE WHEN k % 13 = 0 THEN NULL ELSE 'title' || CAST(k % 7 AS VARCHAR) END AS page_title,
             CASE WHEN event_type = 'signup' AND k % 5 = 0 THEN 'address book' END AS event_category,
             CASE WHEN event_action = 'ship-now' AND k % 2 = 0 THEN 'done' ELSE 'start' END
               AS event_label,
             event_action,
             CASE WHEN event_type = 'error' AND k % 4 = 0 THEN 'reset-password' END AS list_category,
             event_type <> 'view' AS is_interaction
      FROM m_ev2""",
    "m_ato_orders": """
      SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders WHERE o_orderkey % 7 = 0""",
    "m_fraud_orders": """
      SELECT o_orderkey AS order_id FROM orders WHERE o_orderkey % 5 = 0""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every mapping view as a CTE (DuckDB drops unused ones)."""
    views = dict(SQL_VIEWS)
    views.update(extra or {})
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    return f"WITH {ctes}\n{body}"
