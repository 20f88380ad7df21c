"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

def valid_customer(c: str | Column) -> Column:
    """Customer id present and not the anonymous id 0."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != 0)


def days_between(c: str | Column, start: dt.date, end: dt.date) -> Column:
    """Inclusive range on a DATE column (prunes parquet row groups when pushed)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.between(F.lit(start), F.lit(end))


def ts_in_days(c: str | Column, start: dt.date, end: dt.date,
               end_inclusive_midnight: bool = False) -> Column:
    """Timestamp inside the days [start, end].

    Half-open ``>= start and < end + 1 day`` by default; with
    ``end_inclusive_midnight`` the range stops at midnight of ``end``, which is
    what ``ts BETWEEN 'start' AND 'end'`` does in most warehouses.
    """
    c = F.col(c) if isinstance(c, str) else c

    def ntz(d: dt.date) -> Column:
        # parsed from text: no session time zone is involved
        return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")

    lo = ntz(start)
    if end_inclusive_midnight:
        return (c >= lo) & (c <= ntz(end))
    return (c >= lo) & (c < ntz(end + dt.timedelta(days=1)))


# --- deterministic, partition-independent hashing -----------------------------
# MD5 of a canonical key text ("seed|col|col...") is a standard function that
# Spark and DuckDB evaluate identically, so the DuckDB oracle selects exactly
# the rows Spark selects.  The first 32 bits give a uniform number in [0, 1).

def key_text(cols: list[str], seed: int, dialect: str) -> str:
    cast = "string" if dialect == "spark" else "VARCHAR"
    parts = [f"'{int(seed)}'"] + [f"CAST({c} AS {cast})" for c in cols]
    return f"concat_ws('|', {', '.join(parts)})"


def hash_unit(long_cols: list[str], date_cols: list[str] = (), seed: int = 42) -> Column:
    """Uniform number in [0, 1) from key columns and a seed.

    Depends only on the row's key values, never on partitioning or task order,
    so a sample or split is the same after a retry, a repartition or a re-run.
    """
    key = key_text(list(long_cols) + list(date_cols), seed, "spark")
    return F.expr(f"CAST(conv(substring(md5({key}), 1, 8), 16, 10) AS BIGINT) / 4294967296.0")


def hash_unit_sql(long_cols: list[str], date_cols: list[str] = (), seed: int = 42) -> str:
    """The same number as :func:`hash_unit`, as DuckDB SQL text."""
    key = key_text(list(long_cols) + list(date_cols), seed, "duckdb")
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0)"


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 (numpy would give NaN)."""
    return F.try_divide(num, den)
