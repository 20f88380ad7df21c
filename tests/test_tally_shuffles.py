"""The tallies' exploded rows stay in the customer's task: every shuffle is below the explode."""

import contextlib
import io

import pytest

from dayguard.operators import families
from dayguard.params import Params
from dayguard.sources.testdata import load_inputs

P = Params.testdata()


@pytest.mark.parametrize("table", [families.purchase_features, families.new_feature_set])
def test_no_shuffle_after_the_explode(spark, table):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        table(load_inputs(spark, "/root/testdata/sf0.001"), P).explain()
    lines = buf.getvalue().splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-*"))
    first = min(i for i, s in enumerate(lines) if "Generate explode" in s)
    assert not [s for s in lines[:first] if "Exchange" in s]
    for i, s in enumerate(lines):
        if "Generate explode" in s:  # what it reads comes dealt by customer
            below = next(x for x in lines[i + 1:] if "Exchange" in x)
            assert "REPARTITION_BY_NUM" in below and depth(below) > depth(s)
