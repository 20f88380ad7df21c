"""First-seen tallies: "distinct values seen on earlier days" without range joins.

The warehouse formulation pairs every (customer, day) with every earlier row of
the same customer (``t1.day > t2.day``) and counts distinct values: work grows
with the square of the history length and a hot customer lands in one task.

Here the history rows are dealt by customer once, as narrow as the inputs have them; then
every row is exploded into tagged values, and two hash aggregations plus one window, all of
them inside the customer's task, replace those joins:

1. ``groupBy(customer, tag, value).min(day)``: the day each value was first
   seen.
2. ``groupBy(customer, day)``: per tag, how many values were first seen that
   day.  Rows per customer are bounded by the number of days.
3. running sum over ``partitionBy(customer).orderBy(day)`` up to the previous
   row gives "distinct values seen before the day".

Exploded rows are several times as many as the history rows and much wider, so they never
cross the network, and the rows are dealt over ``SPREAD`` times the usual number of tasks
(which AQE leaves as they are) so that a task's values stay in its memory: sized by the
bytes of the narrow rows, the tasks would spill. A hot customer's rows are streamed by one
task, which holds its distinct values only.

A tag may instead be *per day* (its value includes the day) to count distinct
values, or the presence of rows, on each day of a window, and may sum measures
per value.  Rows of step 1 merge associatively, which is what the incremental
state (``state.py``) stores.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


KEY = "customer_id"
DAY = "day"
SPREAD = 4  # tasks of the tallies, times the session's shuffle partitions


def sql_str(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Tally:
    """One counted quantity (expressions are Spark SQL text).

    name:    output count column
    values:  string-valued expressions whose distinct combinations are counted
    longs:   integer-valued expressions counted together with ``values``
             (rows with a NULL in any value are ignored, as ``count(distinct a, b)``)
    per_day: False -> first-seen over the whole history;
             True  -> distinct per day, only for days inside ``window``
    where:   extra row condition (a NULL condition drops the row)
    window:  days of a per-day tally, where they are not the common ones
    keep_null: rows with a NULL value are kept for ``sums`` but not counted; output
             ``<name>_rows`` counts the groups with them
    sums:    long-valued expressions summed per value; output ``<name>_s<i>`` is the day's sum
    doubles: the same for double-valued ones, output ``<name>_d<i>``
    counts:  (name, condition on the sums v0, v1, ... of a value): values that meet it
    """

    name: str
    values: tuple = ()
    per_day: bool = False
    where: str | None = None
    longs: tuple = ()
    window: tuple | None = None
    keep_null: bool = False
    sums: tuple = ()
    doubles: tuple = ()
    counts: tuple = ()


@dataclass(frozen=True)
class Slots:
    """Widths of the payload that all tallies of one pipeline share."""

    strings: int
    longs: int
    sums: int
    doubles: int

    @staticmethod
    def of(tallies: list[Tally]) -> "Slots":
        most = lambda f: max([len(f(t)) for t in tallies] + [0])
        return Slots(most(lambda t: t.values), most(lambda t: t.longs), most(lambda t: t.sums), most(lambda t: t.doubles))

    @property
    def measures(self) -> list[str]:
        return [f"v{i}" for i in range(self.sums)] + [f"w{i}" for i in range(self.doubles)]


def _fields(exprs: tuple, n: int, prefix: str, kind: str) -> list[str]:
    return [f"'{prefix}{i}', CAST({exprs[i] if i < len(exprs) else 'NULL'} AS {kind})" for i in range(n)]


def _item(tag: int, t: Tally, window: tuple[dt.date, dt.date], slots: Slots) -> str:
    """A fixed-width payload: the value e (tag, day, long slots, string slots; unused slots
    NULL) and the measures m to sum per value."""
    conds = [] if t.keep_null else [f"({v}) IS NOT NULL" for v in (*t.values, *t.longs)]
    day = "CAST(NULL AS DATE)"
    if t.per_day:
        day = DAY
        lo, hi = t.window or window
        conds.append(f"{DAY} BETWEEN DATE'{lo.isoformat()}' AND DATE'{hi.isoformat()}'")
    if t.where is not None:
        conds.append(f"coalesce({t.where}, false)")
    cond = " AND ".join(conds) if conds else "true"
    value = [f"'t', {tag}", f"'d', {day}", *_fields(t.longs, slots.longs, "l", "BIGINT"), *_fields(t.values, slots.strings, "s", "STRING")]
    whole = f"'e', named_struct({', '.join(value)})"
    if slots.measures:
        m = _fields(t.sums, slots.sums, "v", "BIGINT") + _fields(t.doubles, slots.doubles, "w", "DOUBLE")
        none = f"CAST(NULL AS STRUCT<{', '.join([f'v{i}: BIGINT' for i in range(slots.sums)] + [f'w{i}: DOUBLE' for i in range(slots.doubles)])}>)"
        whole += f", 'm', {'named_struct(' + ', '.join(m) + ')' if t.sums or t.doubles else none}"
    return f"CASE WHEN {cond} THEN named_struct({whole}) END"


def by_customer(df: DataFrame) -> DataFrame:
    """``df`` dealt by customer: what groups by customer and more needs no further shuffle."""
    return df.repartition(SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), KEY)


def merge_rows(rows: DataFrame, slots: Slots) -> DataFrame:
    """One row per (customer, value): first day and summed measures. Merging is associative,
    so rows of several batches may be merged in any order."""
    return rows.groupBy(KEY, "e").agg(F.min(DAY).alias(DAY), *[F.sum(m).alias(m) for m in slots.measures])


def first_rows(sources: list[tuple[DataFrame, list[Tally]]], window: tuple[dt.date, dt.date], known: DataFrame | None = None) -> DataFrame:
    """(customer_id, e, day, measures): every value of every tally with its first day.

    ``known``: (customer_id, e, day) of earlier rows. They meet the new ones in the same
    aggregation; each new value then has its earlier first day as ``old`` (NULL: none)."""
    tallies = tallies_of(sources)
    slots = Slots.of(tallies)
    tag = {t.name: i for i, t in enumerate(tallies)}
    exploded = None
    for df, ts in sources:
        items = "array(" + ", ".join(_item(tag[t.name], t, window, slots) for t in ts) + ")"
        e = (by_customer(df).select(KEY, DAY, F.explode(F.expr(items)).alias("x")).where("x IS NOT NULL")
             .select(KEY, DAY, "x.e", *[f"x.m.{m}" for m in slots.measures]))
        exploded = e if exploded is None else exploded.unionByName(e)
    if known is None:
        return merge_rows(exploded, slots)
    none = [F.lit(None).cast(exploded.schema[m].dataType).alias(m) for m in (DAY, *slots.measures)]
    earlier = by_customer(known.select(KEY, "e", DAY)).select(KEY, "e", F.col(DAY).alias("old"), *none)
    both = exploded.withColumn("old", F.lit(None).cast("date")).unionByName(earlier)
    return (both.groupBy(KEY, "e").agg(F.min(DAY).alias(DAY), F.min("old").alias("old"), *[F.sum(m).alias(m) for m in slots.measures])
            .where(f"{DAY} IS NOT NULL"))


def tallies_of(sources: list[tuple[DataFrame, list[Tally]]]) -> list[Tally]:
    out = [t for _, ts in sources for t in ts]
    assert len({t.name for t in out}) == len(out), "tally names must be unique"
    return out


def count_columns(t: Tally) -> tuple[list[str], list[str]]:
    """Names of a tally's counts and of its sums."""
    return ([f"{t.name}_rows"] * t.keep_null + [t.name] + [name for name, _ in t.counts],
            [f"{t.name}_s{i}" for i in range(len(t.sums))] + [f"{t.name}_d{i}" for i in range(len(t.doubles))])


def day_counts(first: DataFrame, tallies: list[Tally], of=None) -> DataFrame:
    """Counts and sums per (customer_id, day) from the rows of ``first_rows`` (of the tallies
    that ``of`` holds for, if given)."""
    out = []
    for tag, t in enumerate(tallies):
        if of is not None and not of(t):
            continue
        mine = f"e.t = {tag}"
        named = mine
        if t.keep_null:
            out.append(f"count_if({mine}) AS {t.name}_rows")
            named += "".join(f" AND e.l{i} IS NOT NULL" for i in range(len(t.longs))) + "".join(
                f" AND e.s{i} IS NOT NULL" for i in range(len(t.values)))
        out.append(f"count_if({named}) AS {t.name}")
        out += [f"count_if({named} AND {cond}) AS {name}" for name, cond in t.counts]
        out += [f"sum(CASE WHEN {mine} THEN v{i} END) AS {t.name}_s{i}" for i in range(len(t.sums))]
        out += [f"sum(CASE WHEN {mine} THEN w{i} END) AS {t.name}_d{i}" for i in range(len(t.doubles))]
    return first.groupBy(KEY, DAY).agg(*[F.expr(x) for x in out])


def tally_days(sources: list[tuple[DataFrame, list[Tally]]],
               window: tuple[dt.date, dt.date]) -> DataFrame:
    """Counts per (customer_id, day) for every tally of every source.

    Each source frame must have ``customer_id`` and ``day`` columns plus what
    its tallies reference.  Output: ``customer_id, day, <tally names...>``
    (bigint, 0 when nothing was counted), one row per day with any count.
    """
    return day_counts(first_rows(sources, window), tallies_of(sources))


def before_day(name: str) -> str:
    """Values of tally ``name`` first seen strictly before the row's day (SQL)."""
    return (f"coalesce(sum({name}) OVER (PARTITION BY {KEY} ORDER BY {DAY} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(0 AS BIGINT))")
