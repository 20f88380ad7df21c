"""Daily totals of the one-pass flagship against the separate total operators, on odd rows."""

import dataclasses
import datetime as dt

from dayguard.operators import assemble, basic
from dayguard.params import Params
from dayguard.schema import BASIC_FEATURES, KEY_COLS
from dayguard.sources.tables import Inputs

D = dt.date
T = lambda day, hour=0: dt.datetime(2024, 1, day, hour)


def inputs(spark) -> Inputs:
    line = [  # customer, order, product, placed, status, auto, quantity, price
        (1, 10, 5, T(12), "D", False, 2.0, "10.10"), (1, 10, 5, T(12, 9), "D", None, 1.0, "0.05"), (1, 10, 6, T(12), "X", False, 4.0, "7.00"),
        (1, 11, 6, T(12, 23), "D", True, 1.0, "3.33"), (1, None, 7, T(12), "D", False, 5.0, "1.01"), (1, 12, None, T(12), "D", False, 1.0, "2.00"),
        (1, 13, 5, T(14), None, False, 1.0, None), (2, 20, 9, T(30, 23), "D", False, 3.0, "9.99"), (0, 30, 5, T(12), "D", False, 1.0, "1.00"),
        (None, 31, 5, T(12), "D", False, 1.0, "1.00"), (3, 40, 5, T(3), "D", False, 1.0, "1.00"), (3, 41, 5, T(20), "D", False, 1.0, "1.00")]
    import decimal
    line = [(*x[:7], None if x[7] is None else decimal.Decimal(x[7])) for x in line]
    hit = lambda c, day, prod, click, kind, path, title, inter: (c, D(2024, 1, day), prod, click, kind, path, title, None, None, None, None, inter)
    hits = [hit(1, 12, 5, True, "EVENT", "/a", "t", True), hit(1, 12, 5, None, "PAGE", "/a", "t", None), hit(1, 12, None, True, "PAGE", "/a", None, False),
            hit(1, 12, 6, False, "PAGE", "/b", "t", False), hit(1, 14, None, None, "EVENT", None, None, True), hit(2, 30, 9, True, None, "/a", "t", False),
            hit(0, 12, 5, True, "PAGE", "/a", "t", True)]
    f = spark.createDataFrame
    sessions = [(c, D(2024, 1, d), '{"city": "x"}') for c, d in ((1, 12), (1, 13), (1, 14), (2, 30), (3, 20), (None, 12))]
    return Inputs(
        order_line=f(line, "customer_id long, order_id long, product_id long, order_placed_dttm timestamp_ntz, order_status string, "
                           "order_auto_reorder_flag boolean, order_line_quantity double, order_line_total_price decimal(18,2)"),
        orders=f([], "order_id long, customer_id long, order_placed_dttm timestamp_ntz"),
        product=f([(5, "a", "b"), (6, "ab", None)], "product_id long, category_level1 string, category_level2 string"),
        ga_sessions=f(sessions, "customer_id long, ga_sessions_date date, geo_network string"),
        hits_products=f([], "customer_id long, ga_sessions_date date, product_id long, product_category_level1 string, "
                            "product_category_level2 string, event_action string"),
        hits_union=f(hits, "customer_id long, ga_sessions_date date, product_id long, is_click boolean, type string, page_path string, "
                           "page_title string, event_category string, event_label string, event_action string, list_category string, is_interaction boolean"),
        ato_orders=f([], "order_id long, customer_id long"), fraud_orders=f([], "order_id long"))


def check(spark, p):
    inp = inputs(spark)
    got = {(r[0], r[1]): tuple(r[c] for c in BASIC_FEATURES) for r in assemble.feature_table(inp, p).collect()}
    days = p.basic_start, p.basic_end, p
    o = {(r[KEY_COLS[0]], r[KEY_COLS[1]]): tuple(r[c] for c in BASIC_FEATURES[:8]) for r in basic.order_totals(inp, *days, valid_only=True).collect()}
    h = {(r[KEY_COLS[0]], r[KEY_COLS[1]]): tuple(r[c] for c in BASIC_FEATURES[8:]) for r in basic.hit_totals(inp, *days, valid_only=True).collect()}
    assert set(got) == {(1, D(2024, 1, 12)), (1, D(2024, 1, 13)), (1, D(2024, 1, 14)), (2, D(2024, 1, 30)), (3, D(2024, 1, 20))}
    for k, v in got.items():
        assert v == o.get(k, (None,) * 8) + h.get(k, (None,) * 6), k


def test_totals_agree(spark):
    check(spark, Params.testdata())


def test_totals_agree_with_other_windows(spark):
    """A shorter week of totals, and history that stops at midnight of the last day."""
    p = dataclasses.replace(Params.testdata(), basic_start=D(2024, 1, 13), basic_end=D(2024, 1, 20), end_inclusive_midnight=True)
    check(spark, p)
