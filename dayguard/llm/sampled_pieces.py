"""SentencePiece encoding with Gumbel top-k sampling without replacement, and decoding.

Method: a text's lattice is the product of its chunks' lattices (pieces never cross the
start of a run of spaces or a line end). Backward sums give every edge its conditional
probability. A perturbed search from the top finds the k + 1 segmentations with the
largest Gumbel-perturbed log-probability: the maximum of a subtree is drawn once, one
path inherits it, and the mass of the edges not taken at each node stays on the frontier
as one bound, a Gumbel truncated at its parent's. The best bound is expanded next, so the
segmentations come out distinct and in order of their perturbed score. With kappa the
(k + 1)-th score, a segmentation of log-probability p was included with probability
1 - exp(-exp(p - kappa)). Draws are seeded by the row's key, so retries agree.

The model file is a BPE model; its scores are minus merge ranks. A piece of rank r gets
the Zipf probability 1 / (r + 1) / sum. A character without a piece is its UTF-8 bytes.

Defined cases: null text yields no row; an empty text has one segmentation without
pieces (inclusion 1); texts with at most k segmentations yield all of them (inclusion 1);
repeated rows with one key draw alike; U+2581 in a text reads as a space, as in the format.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayguard.llm.common import slices, tokenizer_file

SPACE = "▁"
_CHUNK = re.compile("▁*[^▁\n]+|▁+|\n")
CACHE = 25_000  # chunk lattices a worker keeps, a few KB each
_MODELS: dict[str, PieceLattices] = {}
SAMPLE = "sample int, n_pieces int, ids array<int>, log_prob double, perturbed double, inclusion double"


class PieceLattices(dict):
    """chunk -> per position ([cumulative probability], [next position], [ids], [log-probability])."""

    def __init__(self, path: str):
        import sentencepiece
        super().__init__()
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        rank = np.array([min(-m.get_score(i), float(n)) for i in range(n)])
        self.piece = [m.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.piece[i][3:5], 16): i for i in range(n) if m.is_byte(i)}
        usable = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
        logp = -np.log(rank + 1) - math.log(float((1 / (rank[usable] + 1)).sum()))
        self.logp = {self.piece[i]: (i, float(logp[i])) for i in usable}
        self.prefix = {p[:k] for p in self.logp for k in range(1, len(p) + 1)}
        self.byte_logp = -math.log(n + 1) - math.log(float((1 / (rank[usable] + 1)).sum()))
        self.of_byte = {i: b for b, i in self.byte.items()}

    def __missing__(self, chunk: str):
        n, logp, prefix = len(chunk), self.logp, self.prefix
        beta, nodes = [0.0] * (n + 1), [None] * n
        for i in range(n - 1, -1, -1):
            nxt, ids, weight = [], [], []
            j = i + 1
            while j <= n and (sub := chunk[i:j]) in prefix:
                if sub in logp:
                    k, w = logp[sub]
                    nxt.append(j)
                    ids.append((k,))
                    weight.append(w + beta[j])
                j += 1
            if not nxt or nxt[0] != i + 1:  # a character without a piece: its bytes
                raw = chunk[i].encode("utf-8", "surrogatepass")
                nxt.insert(0, i + 1)
                ids.insert(0, tuple(self.byte[b] for b in raw))
                weight.insert(0, len(raw) * self.byte_logp + beta[i + 1])
            top = max(weight)
            share = [math.exp(w - top) for w in weight]
            total = sum(share)
            beta[i] = top + math.log(total)
            cum, run = [], 0.0
            for s in share:
                run += s / total
                cum.append(run)
            cum[-1] = 1.0
            nodes[i] = (cum, nxt, ids, [w - beta[i] for w in weight])
        if len(self) > CACHE:
            self.clear()
        self[chunk] = nodes
        return nodes

    def lattices(self, text: str) -> list:
        if not text:
            return []
        return [self[c] for c in _CHUNK.findall(SPACE + text.replace(" ", SPACE))]

    def decode(self, ids: list[int]) -> str:
        out = bytearray()
        for i in ids:
            b = self.of_byte.get(i)
            out += bytes([b]) if b is not None else self.piece[i].encode("utf-8")
        text = out.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


class _Path:
    """A sampled segmentation: its edges, and the frontier bounds it owns."""
    __slots__ = ("nodes", "edge", "logq", "score", "bound", "out")

    def __init__(self, nodes, edge, logq, score, bound, out):
        self.nodes, self.edge, self.logq, self.score, self.bound, self.out = nodes, edge, logq, score, bound, out


def _walk(lattices: list, c: int, i: int, draw) -> tuple[list, list, list]:
    """Edges drawn from chunk c, position i on: (nodes, edge numbers, log-probabilities)."""
    nodes, edge, logq = [], [], []
    for at in range(c, len(lattices)):
        lattice = lattices[at]
        n = len(lattice)
        while i < n:
            node = lattice[i]
            cum = node[0]
            k = bisect_right(cum, draw()) if len(cum) > 1 else 0
            nodes.append((at, i))
            edge.append(k)
            logq.append(node[3][k])
            i = node[1][k]
        i = 0
    return nodes, edge, logq


def _bounds(pre: np.ndarray, alt: np.ndarray, top: float, r) -> np.ndarray:
    """Gumbels of the masses pre + alt, truncated at ``top``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        phi = pre + alt
        g = -np.logaddexp(-top, np.log(r.standard_exponential(len(phi))) - phi)
    return np.where(np.isfinite(phi), g, -np.inf)


def _rest(q: np.ndarray) -> np.ndarray:
    """log(1 - exp(q)); nothing is left where the edge is the only one."""
    with np.errstate(divide="ignore"):
        return np.where(q > -1e-12, -np.inf, np.log(-np.expm1(np.minimum(q, 0))))


def sample(lattices: list, k: int, r) -> list[tuple[list[int], float, float, float]]:
    """[(ids, log-probability, perturbed score, inclusion)], at most k, best first."""
    def draws():
        while True:
            yield from r.random(4096).tolist()

    u = draws().__next__
    top = -math.log(r.standard_exponential())
    nodes, edge, logq = _walk(lattices, 0, 0, u)
    q = np.array(logq)
    paths = [_Path(nodes, edge, q, top, _bounds(np.cumsum(q) - q, _rest(q), top, r), {})]
    while len(paths) <= k:
        best = max(paths, key=lambda p: p.bound.max(initial=-np.inf))
        if not len(best.bound) or best.bound.max() == -np.inf:
            break
        t = int(best.bound.argmax())
        top = float(best.bound[t])
        best.bound[t] = -np.inf
        c, i = best.nodes[t]
        node = lattices[c][i]
        gone = best.out.get(t, frozenset()) | {best.edge[t]}
        left = [e for e in range(len(node[1])) if e not in gone]
        p = np.exp(np.array([node[3][e] for e in left]))
        new = left[min(int(np.searchsorted(np.cumsum(p / p.sum()), u(), side="right")), len(left) - 1)]
        tail = _walk(lattices, c, node[1][new], u)
        q = np.concatenate((best.logq[:t], [node[3][new]], tail[2]))
        pre = np.cumsum(q) - q
        bound = np.full(len(q), -np.inf)
        others = [e for e in left if e != new]
        if others:
            bound[t] = _bounds(pre[t:t + 1], np.array([math.log(sum(math.exp(node[3][e]) for e in others))]), top, r)[0]
        bound[t + 1:] = _bounds(pre[t + 1:], _rest(q[t + 1:]), top, r)
        paths.append(_Path(best.nodes[:t + 1] + tail[0], [*best.edge[:t], new, *tail[1]], q, top, bound, {t: gone}))
    kappa = paths[k].score if len(paths) > k else -math.inf
    out = []
    for p in paths[:k]:
        ids = [x for (c, i), e in zip(p.nodes, p.edge) for x in lattices[c][i][2][e]]
        total = float(p.logq.sum())
        out.append((ids, total, p.score, -math.expm1(-math.exp(min(total - kappa, 700.0))) if kappa > -math.inf else 1.0))
    return out


def model(path: str) -> PieceLattices:
    if path not in _MODELS:
        found = tokenizer_file(path)
        _MODELS[path] = PieceLattices(found)
    return _MODELS[path]


def _encode(path: str, k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for part in slices(batches, 1, most_bytes=1 << 20, most_rows=500):
            out: list[tuple] = []
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text is None:
                    continue
                r = np.random.Generator(np.random.PCG64(xxhash.xxh3_64_intdigest(f"{seed}|{key}".encode())))
                for j, (ids, p, g, inc) in enumerate(sample(m.lattices(text), k, r)):
                    out.append((key, j, len(ids), ids, p, g, inc))
            cols = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.float64()))],
                names=["key", "sample", "n_pieces", "ids", "log_prob", "perturbed", "inclusion"])

    return run


def encode(df: DataFrame, key: Column, text: Column, model_path: str, *, k: int = 4, seed: int = 7) -> DataFrame:
    """(key, SAMPLE...): up to k distinct sampled segmentations of every text; ``key`` (as
    text) seeds the row's draws."""
    return df.select(key.cast("string").alias("key"), text.alias("text")).mapInArrow(
        _encode(model_path, k, seed), f"key string, {SAMPLE}")


def decode(ids: Column, model_path: str) -> Column:
    """The text of a segmentation."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = model(model_path)
        for s in batches:
            yield pd.Series([None if x is None else m.decode(list(x)) for x in s], dtype=object)

    return run(ids)


def crc32_of(ids: Column) -> Column:
    """CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.asarray(x, "<u4").tobytes()) for x in s], dtype="int64")

    return run(ids)
