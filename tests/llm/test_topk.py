"""Groups of buckets, rising bounds and narrow blobs of the top-k search."""

import numpy as np
import pyarrow as pa
import pytest

from dayguard.llm import topk


def brute(q, qid, p, pid, k, bound):
    s = q.astype(object) @ p.T.astype(object)
    return [sorted((-int(x), int(j)) for j, x in zip(pid, s[i]) if j != qid[i] and x >= bound[i])[:k] for i in range(len(q))]


@pytest.mark.parametrize("dim,size", [(6, 300), (6, 40_000), (6, 2 ** 40), (1024, 100)])
def test_all_buckets_give_k_best_once(dim, size):
    r = np.random.default_rng(3)
    p = r.integers(-size, size, (400, dim)) // r.integers(1, 20, 400)[:, None]
    p[300:340] = p[:40]  # equal scores
    q = np.r_[p[:20], p[50:60] + 1, np.zeros((1, dim), np.int64), r.integers(-size, size, (9, dim))]
    if size > 2 ** 20:
        p, q = p >> 12, q >> 12  # sums stay in 64 bits
    pid, qid = r.permutation(400), np.arange(1000, 1040)
    qid[:20] = pid[:20]
    buckets = [topk.Bucket(p[lo:lo + 100], pid[lo:lo + 100]) for lo in range(0, 400, 100)]
    s = (q.astype(float) @ p.T.astype(float))
    for bound in (np.full(40, -np.inf), np.quantile(s, 0.9, axis=1), np.sort(s, axis=1)[:, -7] * (1 - 1e-12) - 1):
        row, ids, score = topk.search_buckets(q, qid, bound, buckets, 5)
        assert len(row) <= 5 * 40
        got = [sorted((-int(x), int(j)) for i, j, x in zip(row, ids, score) if i == n) for n in range(40)]
        assert got == brute(q, qid, p, pid, 5, bound)


def test_coordinates_prune_wide_vectors(monkeypatch):
    monkeypatch.setattr(topk, "COORD_DIM", 6)
    r = np.random.default_rng(4)
    p = np.r_[r.integers(-5, 5, (300, 8)), np.eye(8, dtype=np.int64)[r.integers(0, 8, 100)] * 100 + r.integers(-3, 3, (100, 8))]
    q, qid, pid = p[300:340], np.arange(340 - 40, 340), np.arange(400)
    bound = np.sort(q @ p.T, axis=1)[:, -6].astype(float)
    i, j, s = topk.search_bucket(q, qid, bound, p, pid, 5)
    got = [sorted((-int(x), int(c)) for n, c, x in zip(i, j, s) if n == m) for m in range(40)]
    assert got == brute(q, qid, p, pid, 5, bound)


def test_search_over_many_groups(spark, monkeypatch):
    for name, n in (("BUCKET", 16), ("QUERIES", 8), ("GROUP", 48), ("TOGETHER", 3)):
        monkeypatch.setattr(topk, name, n)
    r = np.random.default_rng(6)
    rows = [(i, [int(x) for x in r.integers(-9, 9, 5 if i % 7 else 3)]) for i in range(500)]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, v array<long>"), topk.F.col("vec_id") % 10 == 0, 4)
    got = sorted(tuple(x) for x in got.collect())
    want = []
    for i, v in rows[::10]:
        s = sorted((-int(np.dot(v, w)), j) for j, w in rows if j != i and len(v) == len(w))[:4]
        want += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s)]
    assert got == want


def test_blobs_are_as_narrow_as_their_numbers(monkeypatch):
    monkeypatch.setattr(topk, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 2})())}))
    for big, width in ((255, 2), (40_000, 4), (2 ** 40, 8)):
        batch = pa.RecordBatch.from_pydict({"dim": pa.array([2] * 5, pa.int32()), "vec_id": pa.array(range(5), pa.int64()),
                                            "v": pa.array([[i, -big] for i in range(5)], pa.list_(pa.int64()))})
        out = list(topk._blocks(2, 7)(iter([batch])))
        assert [len(b["data"][0].as_py()) for b in out] == [4 * width, 4 * width, 2 * width]
        assert [b["deal"][0].as_py() for b in out] == [2, 9, 16]
        ids, m = topk._matrix(out[2]["ids"][0].as_py(), out[2]["data"][0].as_py(), 2)
        assert ids.tolist() == [4] and m.tolist() == [[4, -big]]
