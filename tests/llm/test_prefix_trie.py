"""Prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from dayguard.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            g = hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest()
            own.setdefault(c, []).append((t is not None, t or 0, g, (r, x)))
    own = {c: [v[3] for v in sorted(s)] for c, s in own.items()}
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100 if c >= 0 else c + (-c) % 100, [])[:h] + s[h:]
    return out


def plain(seqs):
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {k: 0 for k in members}
    for k in members:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * (len(k[-1][1]) if k else 0)
    rows = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(k))))
        rows.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=lambda r: (r[1], r[0], r[7]))


def got(df):
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=lambda r: (r[1], r[0], r[7]))


def conversations(r, n):
    rows, deal = [], [f"text {i} " + "é" * i for i in range(4)]
    for c in range(n):
        if c % 7 == 3:  # exact copies
            s = [("user", "same"), ("assistant", "answer"), ("user", "again")]
        else:
            s = [("user" if i % 2 == 0 else "assistant", r.choice(deal)) for i in range(r.randrange(1, 9))]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(s)]
    return rows


@pytest.mark.parametrize("block_rows", [4, 16, 4096])
def test_against_prefixes(spark, block_rows):
    r = random.Random(3)
    rows = conversations(r, 350)
    rows += [(1000, None, "user", "null first"), (1000, 0, "user", None), (1001, 0, None, None), (None, 0, "user", "x"), (1200, 0, "user", "one"),
             (1200, 0, "user", "one"), (100_000, 5, "user", "long" * 50_000), (-5, 0, "user", "same")]
    rows += [(2000, i, "user", "deep") for i in range(60)] + [(2001, i, "user", "deep") for i in range(64)]
    df = spark.createDataFrame([(*x, 1, "k") for x in rows], SCHEMA + ", depth int, key string").repartition(6)
    seqs = P.shared_heads(P.sequences(df))
    assert got(P.trie(seqs, block_rows)) == plain(rebuilt(rows))


def test_copies_over_many_id_ranges(spark):
    ids = [*range(0, 30_000, 3)]
    seqs = spark.createDataFrame([(i, [(b"a" * 16, 5), (b"b" * 16, 7)]) for i in ids], "conv_id long, seq array<struct<g:binary,c:long>>")
    rows = got(P.trie(seqs))
    sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    n = len(ids)
    assert rows == [(0, 0, None, n, 1, 1, (n - 1) * 12, P.EMPTY_SHA), (0, 1, 0, n, 1, 1, (n - 1) * 12, P.EMPTY_SHA),
                    (0, 2, 0, n, 0, 1, (n - 1) * 7, sha)]


def test_range_min_extents():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 5, 200)
    v[0] = -1
    t = P.RangeMin(v)
    for i in range(200):
        for d in range(0, 6):
            lo, hi = i, i
            while lo > 0 and v[lo] >= d:
                lo -= 1
            while hi + 1 < 200 and v[hi + 1] >= d:
                hi += 1
            one = lambda f: int(f(np.array([i]), np.array([d]))[0])  # noqa: E731,B023
            assert (one(t.reach_left), one(t.reach_right)) == (lo, hi)
    lo, hi = np.array([0, 5, 17]), np.array([1, 200, 33])
    assert t.least(lo, hi).tolist() == [v[a:b].min() for a, b in zip(lo, hi)]


def test_empty(spark):
    assert P.trie(P.shared_heads(P.sequences(spark.createDataFrame([], SCHEMA)))).count() == 0
