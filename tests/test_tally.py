"""First-seen tallies against brute force, on hand-made rows."""

import datetime as dt

from dayguard.operators.tally import Tally, before_day, tally_days

D = dt.date


def _brute(rows, base_days, value_idx, window):
    """prev / new counts per (customer, base day) by the written-out definition."""
    out = {}
    for c, d in base_days:
        earlier = {tuple(r[i] for i in value_idx) for r in rows
                   if r[0] == c and r[1] < d and all(r[i] is not None for i in value_idx)}
        today = {tuple(r[i] for i in value_idx) for r in rows
                 if r[0] == c and r[1] == d and all(r[i] is not None for i in value_idx)}
        has_rows = any(r[0] == c and r[1] == d for r in rows) and window[0] <= d <= window[1]
        out[(c, d)] = (len(earlier), len(today - earlier) if has_rows else None)
    return out


def _run(spark, rows, base_days, cols, window):
    hist = spark.createDataFrame(rows, "customer_id long, day date, a string, b string")
    base = spark.createDataFrame(base_days, "customer_id long, day date")
    vals = tuple(cols)
    t = tally_days([(base, [Tally("_b", per_day=True)]),
                    (hist, [Tally("v", vals), Tally("_d", per_day=True)])], window)
    res = (t.selectExpr("customer_id", "day", "_b", f"{before_day('v')} AS prev",
                        "CASE WHEN _d > 0 THEN v END AS new")
           .where("_b > 0").collect())
    return {(r.customer_id, r.day): (r.prev, r.new) for r in res}


ROWS = [
    (1, D(2024, 1, 1), "x", "p"), (1, D(2024, 1, 1), None, "q"), (1, D(2024, 1, 2), "x", None),
    (1, D(2024, 1, 3), "y", "p"), (1, D(2024, 1, 3), "(not set)", "q"), (1, D(2024, 1, 5), "x", "p"),
    (2, D(2024, 1, 2), None, None), (2, D(2024, 1, 4), "z", "r"), (2, D(2024, 1, 4), "z", "r"),
    (3, D(2024, 1, 4), "ab", "c"), (3, D(2024, 1, 5), "a", "bc"),
]
BASE = [(1, D(2024, 1, 2)), (1, D(2024, 1, 3)), (1, D(2024, 1, 4)), (1, D(2024, 1, 5)),
        (2, D(2024, 1, 2)), (2, D(2024, 1, 4)), (3, D(2024, 1, 5)), (4, D(2024, 1, 5))]
WIN = (D(2024, 1, 2), D(2024, 1, 5))


def test_single_value_matches_bruteforce(spark):
    got = _run(spark, ROWS, BASE, ["a"], WIN)
    assert got == _brute(ROWS, BASE, [2], WIN)


def test_pair_ignores_rows_with_null(spark):
    got = _run(spark, ROWS, BASE, ["a", "b"], WIN)
    assert got == _brute(ROWS, BASE, [2, 3], WIN)


def test_day_without_rows_is_null_and_no_history_is_zero(spark):
    got = _run(spark, ROWS, BASE, ["a"], WIN)
    assert got[(1, D(2024, 1, 4))] == (3, None)     # no rows that day -> NULL new
    assert got[(4, D(2024, 1, 5))] == (0, None)     # customer without history -> 0 prev
    assert got[(2, D(2024, 1, 2))] == (0, 0)        # only NULL values that day -> 0 new


def test_concat_key_collides_but_pair_does_not(spark):
    rows = [(3, D(2024, 1, 4), "ab", "c"), (3, D(2024, 1, 5), "a", "bc")]
    base = [(3, D(2024, 1, 5))]
    hist = spark.createDataFrame(rows, "customer_id long, day date, a string, b string")
    b = spark.createDataFrame(base, "customer_id long, day date")
    t = tally_days([(b, [Tally("_b", per_day=True)]),
                    (hist, [Tally("pair", ("a", "b")), Tally("cat", ("concat(a, b)",))])],
                   WIN)
    r = t.selectExpr(f"{before_day('pair')} AS p", "pair", "cat", "_b").where("_b > 0").first()
    assert r.p == 1 and r.pair == 1   # the pair is new
    assert r.cat == 0                 # 'abc' was seen the day before


def test_prev_plus_new_is_next_prev(spark):
    """When every active day is a base day, prev(d) + new(d) = prev(next day)."""
    days = sorted({(r[0], r[1]) for r in ROWS})
    got = _run(spark, ROWS, days, ["a"], (D(2024, 1, 1), D(2024, 1, 5)))
    by_c = {}
    for (c, d), v in got.items():
        by_c.setdefault(c, []).append((d, v))
    for c, lst in by_c.items():
        lst.sort()
        for (d0, (p0, n0)), (d1, (p1, _)) in zip(lst, lst[1:]):
            assert p0 + n0 == p1
            assert p1 >= p0
