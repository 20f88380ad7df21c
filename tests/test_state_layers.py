"""Parts of first days that a batch adds, their counts, and the inputs of the batches."""

import pytest
from pyspark.sql import functions as F

from dayguard.operators import assemble, families, state
from dayguard.operators.state import FeatureState
from dayguard.operators.tally import KEY, first_rows, tallies_of
from dayguard.params import Params
from dayguard.plans.queries import ARRIVING, arrivals, batch_of
from dayguard.sources.parts import content_digest
from dayguard.sources.testdata import load_inputs

P = Params.testdata()


@pytest.fixture(scope="module")
def everything(spark):
    return load_inputs(spark, "/root/testdata/sf0.001")


def rows(df):
    return sorted([tuple(r) for r in df.select(*sorted(df.columns)).collect()], key=repr)


def test_a_batch_adds_only_values_that_are_new_or_earlier(spark, everything, tmp_path):
    s = FeatureState.open(spark, str(tmp_path), P, buckets=4).append("b1", batch_of(everything, 1))
    t = s.append("b2", batch_of(everything, 2)).append("b3", batch_of(everything, 3))
    assert all(t.store.parts[k] == f for k, f in s.store.parts.items() if k[0] in ("seen", "first"))
    fams = families.all_families(everything, P)
    full = first_rows(families.family_sources(everything, P, fams), (P.feature_start, P.feature_end))
    want = full.where("e.d IS NULL").select(KEY, "e", "day")
    kept = t.store.read("seen", want.schema)
    assert rows(kept.groupBy(KEY, "e").agg(F.min("day").alias("day"))) == rows(want)
    twice = kept.groupBy(KEY, "e").agg(F.count_distinct("day").alias("days"), F.count(F.lit(1)).alias("n")).where("n > 1")
    assert 0 < twice.count() < want.count() / 4 and not twice.where("days < n").count()  # values of late rows only
    first = t.store.read("first", state._first_schema(full.schema, tallies_of(families.family_sources(everything, P, fams))))
    counted = first.groupBy("day").agg(F.sum("o_prod").alias("n")).where("n <> 0")
    tag = [x.name for x in tallies_of(families.family_sources(everything, P, fams))].index("o_prod")
    assert rows(counted) == rows(want.where(f"e.t = {tag}").groupBy("day").agg(F.count(F.lit(1)).alias("n")))


def test_many_parts_become_one(spark, everything, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "LAYERS", 1)
    s = FeatureState.open(spark, str(tmp_path), P, buckets=4)
    for b in (3, 1, 2):
        s = s.append(f"b{b}", batch_of(everything, b))
        for kind in ("seen", "first"):
            held = [p.split("-")[0] for k, p in s.store.parts if k == kind]
            assert len(held) == len(set(held))
    assert rows(FeatureState.open(spark, str(tmp_path), P, 4).features()) == rows(assemble.feature_table(everything, P))


def test_arrivals_are_the_batches(spark, everything):
    batch = arrivals(everything)
    for number in (1, 2, 3):
        one, two = batch(number), batch_of(everything, number)
        for n in ARRIVING:
            assert content_digest(getattr(one, n)) == content_digest(getattr(two, n))


def test_digest_is_the_sum_of_the_hashes(spark):
    df = spark.range(1000).withColumn("s", F.col("id").cast("string"))
    h = [r[0] for r in df.select(F.xxhash64("id", "s")).collect()]
    low = 0
    for x in h:
        low ^= x
    assert content_digest(df) == f"1000-{sum(h)}-{low}"


@pytest.mark.parametrize("kind,part", [("seen", "00001"), ("daily", "2024-01-10"), ("daily", "2024-01")])
def test_stores_of_earlier_versions_are_refused(spark, everything, tmp_path, kind, part):
    s = FeatureState.open(spark, str(tmp_path), P, buckets=4).append("b1", batch_of(everything, 1))
    s.store.commit({(kind, part): "somewhere"}, "old", "0")
    with pytest.raises(ValueError):
        FeatureState.open(spark, str(tmp_path), P, buckets=4)
