"""Feature table: 22 first-seen features and 14 daily totals per session day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dayguard.operators.families import all_families, family_table
from dayguard.params import Params
from dayguard.schema import FEATURES, KEY_COLS
from dayguard.sources.tables import Inputs


def feature_table(inp: Inputs, p: Params) -> DataFrame:
    """One row per (CUSTOMER_ID, GA_SESSIONS_DATE) session day, 36 features.

    Equal to ``new features LEFT JOIN (orders FULL JOIN hits)``, whose totals are unique
    per key, but all of it is one tally pipeline that reads each input once: distinct
    orders, products and pages of a day are per-day tallies whose rows carry the day's
    sums, so no join is left but the product dimension's.  (Bitmaps would need one of 4 KB
    per customer-day.)  Nulls are kept; preparation fills them.
    """
    return family_table(inp, p, all_families(inp, p)).select(*KEY_COLS, *FEATURES)
