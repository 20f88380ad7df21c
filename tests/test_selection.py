"""Exact-size selection against sorting."""

import hashlib
import math

import pytest

from dayguard.functions import selection as S

SCHEMA = "c long, d string, x int"


def h(c, d, seed):
    return int(hashlib.md5(f"{seed}|{c}|{d}".encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("k", [0, 1, 7, 333, 999, 1000, 5000])
def test_exactly_k_by_hash(spark, k, monkeypatch):
    monkeypatch.setattr(S, "FETCH", 3)  # so that several rounds of histograms are needed
    rows = [(i, f"d{i % 7}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = {r[0] for r in sorted(rows, key=lambda r: h(r[0], r[1], 9))[:k]}
    marked = S.mark_smallest(df, k, ["c", "d"], 9).collect()
    assert len(marked) == 1000 and {r["c"] for r in marked if r["picked"]} == want


def test_repeated_keys_still_give_exactly_k(spark):
    rows = [(1, "a", i % 3) for i in range(50)] + [(i, "b", 0) for i in range(2, 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    for k in range(1, len(rows) + 1, 5):
        marked = S.mark_smallest(df, k, ["c", "d"], 1)
        assert marked.where("picked").count() == k and marked.count() == len(rows)


def test_share_and_seed(spark):
    assert [S.share_of(n, 0.2) for n in (0, 1, 5, 6)] == [0, 1, 1, 2] and S.share_of(3, 1.0) == 3
    df = spark.createDataFrame([(i, "a", 0) for i in range(400)], SCHEMA)
    one, two = ({r["c"] for r in S.mark_smallest(df, 100, ["c", "d"], s).where("picked").collect()} for s in (1, 2))
    assert one != two and len(one & two) < 60 and math.isclose(len(one), 100)


def test_empty(spark):
    assert S.mark_smallest(spark.createDataFrame([], SCHEMA), 3, ["c"], 1).count() == 0
