"""Ranked search against exhaustive scoring."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from dayguard.llm import pair_maxscore as M

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, items, k=10):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, w) for d, w in held if w]
    n_docs, n_words = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = set()
    for i, q in asked.items():
        scores = []
        for d, w in held:
            m = 10 + (90 * len(w) * n_docs) // n_words
            s = 0
            for t in q & set(w):
                tf = w.count(t)
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out |= {(i, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)}
    return out


def corpus(seed):
    r = random.Random(seed)
    common, rare = [f"w{i}" for i in range(12)], [f"Rare{i}é" for i in range(300)]
    text = lambda n: " ".join(r.choice(common) if r.random() < 0.8 else r.choice(rare) for _ in range(n))
    docs = [(i, text(r.randrange(1, 60))) for i in range(500)]
    docs += [(i, docs[3][1]) for i in range(900, 960)]  # copies: equal scores
    docs += [(3, docs[3][1]), (3, "w1 w2"), (None, docs[3][1]), (2000, None), (2001, ""), (2002, "... !! \x00\x7f"),
             (2003, "w1 " * 30_000 + "Rare7é"), (2004, "naïve_W1—w2w3 ÀÉ")]
    items = [(i, text(r.randrange(3, 40))) for i in range(30)]
    items += [(100, docs[3][1]), (100, "w5"), (101, None), (102, ""), (103, "nowhere"), (None, "Rare1é w0"), (104, "À é ïve w1—W2W3")]
    return docs, items


@pytest.mark.parametrize("block_docs", [7, 4096])
def test_against_exhaustive(spark, block_docs):
    docs, items = corpus(5)
    d = spark.createDataFrame([(*x, 1, "t") for x in docs], "doc_id long, text string, rank int, term string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in M.search(d, q, at_once=20, block_docs=block_docs).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(docs, items)


def test_empty(spark):
    docs, items = corpus(6)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert M.search(d.where("false"), q).count() == 0 and M.search(d, q.where("false")).count() == 0


def test_pair_bounds_are_tighter_and_hold():
    """Two heavy terms that never meet: the pair's bound is the larger, not the sum."""
    largest = {0: 100, 1: 90, 2: 10}
    assert M.bound_groups([0, 1, 2], largest, [(0, 1, 0)]) == [(10, (2,)), (100, (0, 1))]
    assert M.bound_groups([0, 1, 2], largest, [(0, 1, 150), (1, 2, 0)]) == [(10, (2,)), (150, (0, 1))]
    assert sum(b for b, _ in M.bound_groups([0, 1, 2], largest, [])) == 200


def _block(lists, joint, n):
    term = sorted(lists)
    cols = {"doc_id": list(range(n)), "df": [len(lists[t]) for t in term], "doc": [d for t in term for d, _ in lists[t]],
            "impact": [v for t in term for _, v in lists[t]], "term": term, "largest": [max(v for _, v in lists[t]) for t in term],
            "pair": list(joint), "joint": list(joint.values())}
    return M.BlockIndex(pa.RecordBatch.from_pydict({k: [v] for k, v in cols.items()}), 0)


def test_blocks_are_skipped_by_pairs_only():
    lists = {0: [(0, 50), (2, 60)], 1: [(1, 70), (3, 40)]}
    with_pair, without = _block(lists, {9: 0}, 4), _block(lists, {}, 4)
    at, _ = with_pair.top([0, 1], [(9, 0, 1)], 100, 10)
    assert not len(at) and with_pair.skipped == 1
    without.top([0, 1], [(9, 0, 1)], 100, 10)
    assert without.skipped == 0


def test_top_returns_all_at_the_threshold():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n, lists = 40, {}
        for t in range(6):
            d = np.flatnonzero(rng.random(n) < 0.4)
            if len(d):
                lists[t] = [(int(x), int(rng.integers(1, 9))) for x in d]
        pairs, joint = [], {}
        for p, (a, b) in enumerate([(0, 1), (2, 3), (1, 2), (4, 5)]):
            pairs.append((p, a, b))
            if a in lists and b in lists:
                x, y = dict(lists[a]), dict(lists[b])
                joint[p] = max([x[d] + y[d] for d in x.keys() & y.keys()], default=0)
        want = {}
        for t in lists:
            for d, v in lists[t]:
                want[d] = want.get(d, 0) + v
        cut = int(rng.integers(0, 25))
        at, score = _block(lists, joint, n).top(range(6), pairs, cut, 5)
        ranked = sorted(((-s, d) for d, s in want.items() if s >= cut))[:5]
        assert [(d, -s) for s, d in ranked] == [(d, s) for d, s in zip(at.tolist(), score.tolist()) if s >= cut]
