"""Scans of the input tables.

Every reader returns a lazy DataFrame; Catalyst pushes the later column
selection and filters into the parquet scan (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet scan; ``spark.sql.files.maxPartitionBytes`` of the session decides how it is split."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def file_marks(spark: SparkSession, base: str, names: tuple) -> str:
    """Lengths and times of the tables' files, as the file system lists them."""
    out = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            out += [f"{s.getLen()}-{s.getModificationTime()}" for s in fs.listStatus(path)]
    return ",".join(out)


@dataclass
class Inputs:
    """The seven inputs of the reference pipeline, in its own schemas.

    order_line:   customer_id, order_id, product_id, order_placed_dttm,
                  order_status, order_auto_reorder_flag, order_line_quantity,
                  order_line_total_price
    orders:       order_id, customer_id, order_placed_dttm
    product:      product_id, category_level1, category_level2
    ga_sessions:  customer_id, ga_sessions_date, geo_network (JSON text)
    hits_products: customer_id, ga_sessions_date, product_id,
                  product_category_level1, product_category_level2, event_action
    hits_union:   customer_id, ga_sessions_date, product_id, is_click, type,
                  page_path, page_title, event_category, event_label,
                  event_action, list_category, is_interaction
    ato_orders:   order_id, customer_id            (label file)
    fraud_orders: order_id, fraud_flag, fraud_return, chargeback_flag
    """

    order_line: DataFrame
    orders: DataFrame
    product: DataFrame
    ga_sessions: DataFrame
    hits_products: DataFrame
    hits_union: DataFrame
    ato_orders: DataFrame
    fraud_orders: DataFrame

    @staticmethod
    def from_tables(spark: SparkSession, *, order_line: str, orders: str, product: str,
                    ga_sessions: str, hits_products: str, hits_union: str,
                    ato_orders: DataFrame, fraud_orders: DataFrame) -> "Inputs":
        """Inputs from catalog tables in the production schemas (names as
        ``db.table``) and the two label frames (see :mod:`dayguard.sources.csvio`
        for reading the label files).  Only the used columns are selected, so
        the scans are pruned."""
        def t(name, cols):
            return spark.table(name).select(*cols)
        return Inputs(
            order_line=t(order_line, ORDER_LINE_COLS), orders=t(orders, ORDERS_COLS),
            product=t(product, PRODUCT_COLS), ga_sessions=t(ga_sessions, SESSION_COLS),
            hits_products=t(hits_products, HITS_PRODUCTS_COLS),
            hits_union=t(hits_union, HITS_UNION_COLS),
            ato_orders=ato_orders.select("order_id", "customer_id"),
            fraud_orders=fraud_orders.select("order_id"))


# columns each input must provide
ORDER_LINE_COLS = ["customer_id", "order_id", "product_id", "order_placed_dttm", "order_status",
                   "order_auto_reorder_flag", "order_line_quantity", "order_line_total_price"]
ORDERS_COLS = ["order_id", "customer_id", "order_placed_dttm"]
PRODUCT_COLS = ["product_id", "category_level1", "category_level2"]
SESSION_COLS = ["customer_id", "ga_sessions_date", "geo_network"]
HITS_PRODUCTS_COLS = ["customer_id", "ga_sessions_date", "product_id", "product_category_level1",
                      "product_category_level2", "event_action"]
HITS_UNION_COLS = ["customer_id", "ga_sessions_date", "product_id", "is_click", "type", "page_path",
                   "page_title", "event_category", "event_label", "event_action", "list_category",
                   "is_interaction"]
