"""Batches in any order, repeated and interrupted, against one run over everything."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from dayguard.operators import assemble
from dayguard.operators.state import FeatureState
from dayguard.params import Params
from dayguard.plans.queries import batch_of
from dayguard.sources.parts import Store
from dayguard.sources.testdata import load_inputs

SF = "/root/testdata/sf0.001"
P = Params.testdata()


@pytest.fixture(scope="module")
def everything(spark):
    return load_inputs(spark, SF)


@pytest.fixture(scope="module")
def want(everything):
    return rows(assemble.feature_table(everything, P))


def rows(df):
    return sorted([tuple(r) for r in df.select(*sorted(df.columns)).collect()], key=repr)


@pytest.mark.parametrize("order", [(1, 2, 3), (3, 1, 2)])
def test_any_order_of_batches_is_the_full_run(spark, everything, want, tmp_path, order):
    s = FeatureState.open(spark, str(tmp_path), P, buckets=4)
    for b in order:
        s = s.append(f"b{b}", batch_of(everything, b))
    assert rows(s.features()) == want
    assert rows(FeatureState.open(spark, str(tmp_path), P, 4).features()) == want


def test_rerun_and_kill_leave_equal_tables(spark, everything, want, tmp_path, monkeypatch):
    s = FeatureState.open(spark, str(tmp_path), P, buckets=4)
    s = s.append("b1", batch_of(everything, 1))
    before = rows(s.features())
    with monkeypatch.context() as m:  # killed after all files, before the manifest
        m.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            s.append("rest", _rest(everything))
    s = FeatureState.open(spark, str(tmp_path), P, 4)
    assert s.store.version == 1 and rows(s.features()) == before
    s = s.append("b1", batch_of(everything, 1))  # again: nothing changes
    assert s.store.version == 1
    with pytest.raises(ValueError):
        s.append("b1", batch_of(everything, 2))
    s = s.append("rest", _rest(everything)).append("rest", _rest(everything))
    assert s.store.version == 2 and rows(s.features()) == want


def _rest(inp):
    two, three = batch_of(inp, 2), batch_of(inp, 3)
    both = {f.name: getattr(two, f.name).unionByName(getattr(three, f.name)) for f in dataclasses.fields(inp)
            if f.name in ("order_line", "ga_sessions", "hits_products", "hits_union")}
    return dataclasses.replace(inp, **both)


def test_only_touched_parts_are_written(spark, everything, tmp_path):
    s = FeatureState.open(spark, str(tmp_path), P, buckets=16).append("b1", batch_of(everything, 1))
    one = batch_of(everything, 2)
    only = {n: getattr(one, n).where("customer_id = 7") for n in ("order_line", "ga_sessions", "hits_products", "hits_union")}
    t = s.append("one customer", dataclasses.replace(one, **only))
    moved = {k for k, f in t.store.parts.items() if s.store.parts.get(k) != f}
    assert sum(k == "seen" for k, _ in moved) == 1 and len([k for k in t.store.parts if k[0] == "seen"]) > 8
    assert t.features().where(F.col("CUSTOMER_ID") != 7).count() == s.features().where(F.col("CUSTOMER_ID") != 7).count()


def test_days_without_new_rows_are_not_written_again(spark, everything, tmp_path):
    s = FeatureState.open(spark, str(tmp_path), P, buckets=4).append("b1", batch_of(everything, 1))
    t = s.append("b2", batch_of(everything, 2))
    old = {k: f for k, f in s.store.parts.items() if k[0] == "daily"}
    assert old and all(t.store.parts[k] == f for k, f in old.items())  # batch 2 has later days only
    assert any(k[0] == "daily" and k not in old for k in t.store.parts)


def test_empty_batch(spark, everything, tmp_path):
    none = {n: getattr(everything, n).where("false") for n in ("order_line", "ga_sessions", "hits_products", "hits_union")}
    s = FeatureState.open(spark, str(tmp_path), P, 4).append("none", dataclasses.replace(everything, **none))
    assert s.features().count() == 0 and s.store.version == 1
