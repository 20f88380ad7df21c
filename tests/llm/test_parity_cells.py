"""Cells of op6_parity_join and the pipeline's near copies: few, none of them empty, and none of the links lost."""

import random

import numpy as np
import pytest

from dayguard.llm import parity_join

SPECS = [parity_join.JoinSpec(3, 90, 100), parity_join.JoinSpec(5, 80, 100), parity_join.JoinSpec(2, 50, 100)]


def keys_of(sets, spec):
    flat = np.concatenate([np.sort(np.array(sorted(s), np.uint64)) for s in sets])
    keys, made = parity_join.sketches(flat, np.array([len(s) for s in sets]), spec)
    assert made.sum() == len(keys)
    return [set(k.tolist()) for k in np.split(keys, np.cumsum(made)[:-1])]


@pytest.mark.parametrize("spec", SPECS)
def test_linked_sets_share_a_cell(spec):
    r, linked = random.Random(5), 0
    for _ in range(600):
        n = r.randint(1, r.choice([4, 30, 700]))
        a = {r.getrandbits(64) for _ in range(n)}
        b = set(sorted(a, key=lambda _: r.random())[r.randint(0, n // 5):]) | {r.getrandbits(64) for _ in range(r.randint(0, n // 5))}
        if spec.den * len(a & b) >= spec.num * len(a | b):
            linked += 1
            x, y = keys_of([a, b], spec)
            assert x & y
    assert linked > 100


@pytest.mark.parametrize("spec", SPECS[:2])
def test_unlike_sets_share_no_cell(spec):
    r = random.Random(6)
    sets = [{r.getrandbits(64) for _ in range(r.randint(100, 600))} for _ in range(300)]
    keys = keys_of(sets, spec)
    shared = sum(map(len, keys)) - len(set().union(*keys))
    assert shared < 0.02 * sum(map(len, keys))  # empty cells were shared by all sets of a band
    assert sum(map(len, keys)) < 0.36 * sum(map(len, sets))


def test_stored_tables_leave_no_shuffle_files(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(parity_join, "stored", lambda df: seen.append(spark.conf.get(parity_join.CLEANUP)) or df)
    before = spark.conf.get(parity_join.CLEANUP, "false")
    parity_join.spool(spark.range(3))
    assert seen == ["true"] and spark.conf.get(parity_join.CLEANUP, "false") == before


def test_only_members_of_several_roots_are_joined_with_their_sketches(spark, monkeypatch):
    spec, words = parity_join.JoinSpec(3, 90, 100), lambda i, n: [f"w{i}x{j}" for j in range(n)]
    texts = {i: words(i, 200) for i in range(20)}
    texts |= {20: texts[3][:190] + words(20, 10), 21: texts[3][:180] + words(21, 20)}  # 3 and 20 link, 21 links with neither
    texts = {i: " ".join(w) for i, w in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    summary = spark.createDataFrame(docs.mapInArrow(parity_join._summaries(spec), "doc_id long, n long, x long, y long, parity array<long>, low array<long>, cells array<long>").collect())
    rows = spark.createDataFrame([(i, i) for i in texts], "doc long, root long")
    wide, spool = [], parity_join.spool
    monkeypatch.setattr(parity_join, "spool", lambda df: (wide.append(df) if "p0" in df.columns else None) or spool(df))
    pairs, _ = parity_join._across(rows, docs, summary, spec)
    assert {tuple(p) for p in pairs.collect()} >= {(3, 20)}
    (first,) = wide
    found = [(r["member"], r["doc"]) for r in first.collect()]
    assert found and {d for _, d in found} <= {3, 20, 21}  # members of one text alone met nothing
    assert all(sum(m == x for x, _ in found) > 1 for m, _ in found)
