"""Plan shape of the flagship: no range join left, pruned scans, pushed filters."""

import contextlib
import io

from dayguard.operators import assemble
from dayguard.params import Params
from dayguard.sources.testdata import load_inputs

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_plan_has_no_range_join_and_prunes(spark):
    plan = _plan(assemble.feature_table(load_inputs(spark, SF), Params.testdata()))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    # one window (the running sums), partitioned by customer only
    assert plan.count("Window ") <= 2
    # events are read without the unused columns
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert all("event_id" not in s and "value" not in s for s in schemas)
    # day window and customer filters reach the parquet reader
    pushed = " ".join(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "LessThan(ts,2024-01-31T00:00)" in pushed
    assert "Not(EqualTo(user_id,0))" in pushed


def test_flagship_reads_every_input_once(spark):
    """Seven scans: order lines (two tables) and their product dimension, sessions, hits,
    product hits with their product dimension; no join but those of the mapping."""
    plan = _plan(assemble.feature_table(load_inputs(spark, SF), Params.testdata()))
    details = plan[plan.index("\n(1)"):]
    roots = [line for line in details.splitlines() if line.startswith("Location:")]
    assert len(roots) == 7, roots
    assert sum("lineitem.parquet" in r for r in roots) == 1 and sum("/orders.parquet" in r for r in roots) == 1
    assert sum("events.parquet" in r for r in roots) == 3 and sum("part.parquet" in r for r in roots) == 2
    joins = [line for line in details.splitlines() if line.startswith("(") and "Join" in line]
    assert len(joins) == 3, joins
