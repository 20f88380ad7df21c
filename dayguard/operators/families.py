"""Feature families 1-22: city, product clicks, product purchases, behaviour.

Each family is a list of tally sources plus output columns; any set of
families is computed by ONE tally pipeline (two aggregations and one window,
no joins), keyed by the session days.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayguard.functions.columns import ts_in_days, valid_customer
from dayguard.operators import staging
from dayguard.operators.tally import Tally, before_day, day_counts, first_rows, sql_str, tallies_of
from dayguard.params import Params
from dayguard.schema import (BEHAVIOR_FEATURES, CITY_FEATURES, CLICK_FEATURES, HIT_FEATURES, KEY_COLS,
                             ORDER_FEATURES, PURCHASE_FEATURES)
from dayguard.sources.tables import Inputs

BASE = "_base"


@dataclass
class Family:
    sources: list = field(default_factory=list)   # [(DataFrame, [Tally])]
    outputs: list = field(default_factory=list)   # [(name, SQL expression on the tally frame)]


def _flag(name: str) -> str:
    return f"CASE WHEN {name} > 0 THEN 1 ELSE 0 END"


def _when_present(marker: str, expr: str) -> str:
    """NULL on days the daily table has no row (a left join miss)."""
    return f"CASE WHEN {marker} > 0 THEN {expr} END"


def city_family(inp: Inputs, p: Params) -> Family:
    """Features 1-4.  ``'(not set)'`` is a city; NULL cities are ignored."""
    ci = staging.city_info(inp, p)
    tallies = [
        Tally("c_seen", ("city",)),
        Tally("c_day", per_day=True),
        Tally("c_daily", ("city",), per_day=True),
        Tally("c_notset", per_day=True, where=f"city = {sql_str(p.not_set_city)}"),
    ]
    out = [
        (CITY_FEATURES[0], before_day("c_seen")),
        (CITY_FEATURES[1], _when_present("c_day", "c_daily")),
        (CITY_FEATURES[2], _when_present("c_day", "c_seen")),
        (CITY_FEATURES[3], _flag("c_notset")),
    ]
    return Family([(ci, tallies)], out)


def _product_family(hist: DataFrame, prefix: str, names: list[str], where: str | None = None) -> Family:
    """prev: product, level 1, the (level1, level2) pair; new: product, level 1
    and ``concat(level1, level2)`` without separator (('ab','c') = ('a','bc'))."""
    tallies = [
        Tally(f"{prefix}_prod", longs=("product_id",), where=where),
        Tally(f"{prefix}_l1", ("level1",), where=where),
        Tally(f"{prefix}_pair", ("level1", "level2"), where=where),
        Tally(f"{prefix}_cat", ("concat(level1, level2)",), where=where),
        Tally(f"{prefix}_day", per_day=True, where=where),
    ]
    day = f"{prefix}_day"
    out = [
        (names[0], before_day(f"{prefix}_prod")),
        (names[1], before_day(f"{prefix}_l1")),
        (names[2], before_day(f"{prefix}_pair")),
        (names[3], _when_present(day, f"{prefix}_prod")),
        (names[4], _when_present(day, f"{prefix}_l1")),
        (names[5], _when_present(day, f"{prefix}_cat")),
    ]
    return Family([(hist, tallies)], out)


def click_family(inp: Inputs, p: Params) -> Family:
    """Features 5-10 (new-* NULL on days without clicks)."""
    return _product_family(staging.product_click(inp, p), "k", CLICK_FEATURES)


def purchase_family(inp: Inputs, p: Params) -> Family:
    """Features 11-16 (new-* NULL on days without orders)."""
    return _product_family(staging.order_info(inp, p, distinct=True), "o", PURCHASE_FEATURES)


# fixed values: (list_category | event_category, event_action, event_label) rules
BEHAVIOR_RULES = {
    "HAS_RESET_PASSWORD_FLAG": "list_category = 'reset-password'",
    "HAS_ADD_NEW_ADDRESS_FLAG": "event_category = 'address book' AND event_action = 'clicked add'",
    "HAS_APPLIED_GIFTCARD_FLAG": "event_action = 'gift-card-applied'",
    "HAS_CHANGE_AUTOSHIP_FREQUENCY_FLAG": "event_action = 'autoship-change-frequency-increment'",
    "HAS_AUTOSHIP_SHIP_NOW_FLAG": "event_action = 'ship-now' AND event_label = 'done'",
    "HAS_ADD_PAYMENT_FLAG": "event_action = 'add-payment-method'",
}


def behavior_family(inp: Inputs, p: Params) -> Family:
    """Features 17-22: NULL on days without any interaction, else 0/1."""
    tallies, out = _behavior_tallies()
    return Family([(staging.ga_behavior(inp, p), tallies)], out)


def _behavior_tallies(where: str = "true") -> tuple[list, list]:
    tallies, out = [Tally("b_day", per_day=True, where=where)], []
    for i, name in enumerate(BEHAVIOR_FEATURES):
        tallies.append(Tally(f"b_{i}", per_day=True, where=f"{where} AND {BEHAVIOR_RULES[name]}"))
        out.append((name, _when_present("b_day", _flag(f"b_{i}"))))
    return tallies, out


def _both_windows(p: Params) -> tuple[dt.date, dt.date]:
    """The days that history or daily totals need."""
    return min(p.history_start, p.basic_start), max(p.history_end, p.basic_end)


def _in_history(p: Params) -> str:
    return f"day BETWEEN DATE'{p.history_start.isoformat()}' AND DATE'{p.history_end.isoformat()}'"


def purchase_total_family(inp: Inputs, p: Params) -> Family:
    """Features 11-16 and 23-30 from one read of the order lines.

    Totals are tallies per order and per product with their sums: one row per
    (customer, day, order) carries quantities and prices (cents, so sums are exact),
    and a value with a "one-time" line counts as one-time. "One-time" = not an
    auto-reorder and delivered; a NULL reorder flag counts as not one-time.
    """
    day = F.to_date("order_placed_dttm")
    delivered = F.col("order_status") == p.delivered_status
    lines = (inp.order_line.where(day.between(*map(F.lit, _both_windows(p))) & valid_customer("customer_id"))
             .select("customer_id", day.alias("day"), "product_id", "order_id",
                     ts_in_days("order_placed_dttm", p.history_start, p.history_end, p.end_inclusive_midnight).alias("in_history"),
                     F.coalesce(delivered, F.lit(False)).alias("delivered"),
                     F.coalesce(~F.col("order_auto_reorder_flag") & delivered, F.lit(False)).alias("onetime"),
                     F.col("order_line_quantity").cast("double").alias("qty"),
                     (F.col("order_line_total_price").cast("decimal(18,2)") * 100).cast("long").alias("cents")))
    prod = inp.product.select("product_id", F.col("category_level1").alias("level1"), F.col("category_level2").alias("level2"))
    fam = _product_family(lines.join(prod, "product_id", "left"), "o", PURCHASE_FEATURES, "in_history AND product_id IS NOT NULL")
    total = {"per_day": True, "window": (p.basic_start, p.basic_end), "keep_null": True}
    one, of = "CAST(onetime AS BIGINT)", "CASE WHEN {} THEN {} ELSE 0 END"
    fam.sources[0][1].extend([
        Tally("t_order", longs=("order_id",), sums=(one, of.format("delivered", "cents"), of.format("onetime", "cents")),
              doubles=(of.format("onetime", "qty"), of.format("delivered", "qty")), counts=(("t_order_one", "v0 > 0"),), **total),
        Tally("t_product", longs=("product_id",), sums=(one,), counts=(("t_product_one", "v0 > 0"),), **total)])
    exprs = ("t_order", "t_order_one", "t_product", "t_product_one", "t_order_d0", "t_order_d1",
             "CAST(t_order_s1 / 100.0D AS DOUBLE)", "CAST(t_order_s2 / 100.0D AS DOUBLE)")
    fam.outputs += [(n, _when_present("t_order_rows", x)) for n, x in zip(ORDER_FEATURES, exprs)]
    return fam


def hit_family(inp: Inputs, p: Params) -> Family:
    """Features 17-22 and 31-36 from one read of the hits.

    TOTAL_PAGES_VIEWED is NULL (not 0) on days without page hits; a page with a NULL
    path or title is not counted in DISTINCT_PAGES_VIEWED.
    """
    hits = (inp.hits_union.where(F.col("ga_sessions_date").between(*map(F.lit, _both_windows(p))) & valid_customer("customer_id"))
            .withColumnRenamed("ga_sessions_date", "day"))
    tallies, out = _behavior_tallies(f"is_interaction AND {_in_history(p)}")
    window = (p.basic_start, p.basic_end)
    page = f"type = {sql_str(p.page_type)}"
    tallies += [
        Tally("h_product", longs=("product_id",), per_day=True, window=window, keep_null=True, counts=(("h_clicked", "v1 > 0"),),
              sums=("CASE WHEN product_id IS NOT NULL THEN 1 ELSE 0 END",
                    "CASE WHEN is_click AND product_id IS NOT NULL THEN 1 ELSE 0 END", f"CASE WHEN {page} THEN 1 END")),
        Tally("h_page", ("concat(page_path, ',', page_title)",), per_day=True, window=window, where=page)]
    exprs = ("h_product", "h_product_s0", "h_clicked", "h_product_s1", "h_product_s2", "h_page")
    return Family([(hits, tallies)], out + [(n, _when_present("h_product_rows", x)) for n, x in zip(HIT_FEATURES, exprs)])


def all_families(inp: Inputs, p: Params) -> list[Family]:
    """The 36 features; every input is read once."""
    return [city_family(inp, p), click_family(inp, p), purchase_total_family(inp, p), hit_family(inp, p)]


def family_sources(inp: Inputs, p: Params, families: list[Family]) -> list:
    """Sources of the families with the session days as a per-day tally.

    When the city family already reads the sessions (over the history window, which
    contains the feature window) the marker rides on the same scan.
    """
    sources = [s for f in families for s in f.sources]
    base_tally = Tally(BASE, per_day=True)
    city = [i for i, (_, ts) in enumerate(sources) if any(t.name == "c_seen" for t in ts)]
    if city and p.history_start <= p.feature_start and p.feature_end <= p.history_end:
        df, ts = sources[city[0]]
        sources[city[0]] = (df, ts + [base_tally])
    else:
        sources = [(staging.session_days(inp, p), [base_tally])] + sources
    return sources


def outputs_of(counts: DataFrame, families: list[Family]) -> DataFrame:
    """Feature rows of the session days from the counts per (customer, day)."""
    cols = [f"{expr} AS {name}" for f in families for name, expr in f.outputs]
    return (counts.selectExpr(f"customer_id AS {KEY_COLS[0]}", f"day AS {KEY_COLS[1]}", BASE, *cols)
            .where(f"{BASE} > 0").drop(BASE))


def family_table(inp: Inputs, p: Params, families: list[Family]) -> DataFrame:
    """One row per session day (customer, day) with the families' features."""
    sources = family_sources(inp, p, families)
    first = first_rows(sources, (p.feature_start, p.feature_end))
    return outputs_of(day_counts(first, tallies_of(sources)), families)


def city_features(inp: Inputs, p: Params) -> DataFrame:
    return family_table(inp, p, [city_family(inp, p)])


def click_features(inp: Inputs, p: Params) -> DataFrame:
    return family_table(inp, p, [click_family(inp, p)])


def purchase_features(inp: Inputs, p: Params) -> DataFrame:
    return family_table(inp, p, [purchase_family(inp, p)])


def new_feature_set(inp: Inputs, p: Params) -> DataFrame:
    """Features 1-22 for every session day in one tally pipeline."""
    return family_table(inp, p, [city_family(inp, p), click_family(inp, p),
                                 purchase_family(inp, p), behavior_family(inp, p)])


def behavior_flags(inp: Inputs, p: Params) -> DataFrame:
    """The behaviour table itself: one row per interaction day (feature window)."""
    b = staging.ga_behavior(inp, p).where(
        F.col("day").between(F.lit(p.feature_start), F.lit(p.feature_end)))
    return (b.groupBy(F.col("customer_id").alias(KEY_COLS[0]), F.col("day").alias(KEY_COLS[1]))
            .agg(*[F.expr(f"max(CASE WHEN {BEHAVIOR_RULES[n]} THEN 1 ELSE 0 END)").alias(n)
                   for n in BEHAVIOR_FEATURES]))
