"""Best-fit packing of documents into sequences by length patterns.

Method: the pieces' length histogram (at most ``capacity`` numbers, whatever the data)
is cut into bins; all patterns of at most ``MAX_DOCS`` bins that fill a sequence are
enumerated and their repeat counts fitted to the histogram by non-negative least squares
(active set), rounded and limited to what there is; the smallest document of a pattern of
``MAX_DOCS`` is left open. The residual pieces are packed best
fit, longest first, into the gaps the patterns left and into new sequences. Pieces of one
length are interchangeable, so the plan is a table of runs: pieces first..first+count-1 of
a length go to sequences s..s+count-1 at an offset. Pieces get their rank inside their
length by salted windows, so no length, however common, meets in one task.

Defined cases: null text is empty and yields one piece, the end id alone; rows with a
repeated id are packed each; a null id stays null; an empty table packs into no sequence.
"""

from __future__ import annotations

import bisect
import itertools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayguard.llm.common import ragged, slices, spool, tokenizer_file

CAPACITY, END_ID = 4096, 1
BINS, MAX_DOCS = 128, 3
SHARES = (1.0, 0.9, 0.75, 0.5)  # of the fitted repeat counts; the plan with the fewest sequences is taken
CACHE = 200_000  # chunks a worker keeps
# Latin letters that fold case one by one and are in composed form, then ASCII symbols (no apostrophe)
_LETTER, _SYMBOL = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f])", "([!-&(-/:-@\\[-`{-~])"
_LATIN = re.compile(f"({_LETTER[1:-1]}+)({_SYMBOL[1:-1]}*)")
_MARKS = frozenset(".,!?;:")
_ENCODERS: dict[str, ChunkIds] = {}


class ChunkIds(dict):
    """Ids (little-endian uint32 bytes) of the chunks between spaces and line ends.

    The tokenizer drops white space and never joins across it, so a text's ids are its
    chunks' ids one after the other. It folds case, and a run of letters and a run of
    symbols are tokenized each by itself, so a chunk of Latin letters with symbols after
    them is two lookups and few chunks need the whole tokenizer.
    """

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {c: spell(chr(c))[0][0] for c in range(0xc0, 0x250)}  # the letters of _LETTER beyond ASCII

    def letters(self, word: str) -> bytes:
        """Ids of lower-case Latin letters: the merges of their bytes."""
        tokens = self.tokenizer.model.tokenize(word if word.isascii() else word.translate(self.spelled))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk[:-1].isalnum() and chunk[-1] in _MARKS:
            ids = self[chunk[:-1]] + self[chunk[-1]]
        elif m := _LATIN.fullmatch(chunk):
            low = m[1].lower()
            if m[2]:
                ids = self[low] + self[m[2]]
            elif low != chunk:
                ids = self[low]
            else:
                ids = self.letters(chunk)
        else:
            ids = self.whole(chunk)
        self[chunk] = ids
        return ids

    def text(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text:  # strings of special tokens are matched before anything is cut
            return self.whole(text)
        if len(self) > CACHE:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids of each); no text is null or holds ``<|``.

        A-Z are folded and letters parted from the symbols after them, as the tokenizer does;
        then chunks are dictionary-encoded, so each distinct one of the batch is looked up
        once and its ids are gathered by number.
        """
        if len(self) > CACHE:
            self.clear()
        parted = pc.replace_substring_regex(pc.ascii_lower(pc.replace_substring(texts, "\n", " ")), _LETTER + _SYMBOL, r"\1 \2")
        lists = pc.split_pattern(parted, " ")
        coded = lists.flatten().dictionary_encode()
        known = [self[c] for c in coded.dictionary.to_pylist()]
        sizes = np.array([len(b) // 4 for b in known], np.int64)
        at = coded.indices.to_numpy(zero_copy_only=False)
        each = sizes[at]
        ids = np.frombuffer(b"".join(known), "<u4")[ragged((np.cumsum(sizes) - sizes)[at], each)]
        upto = np.concatenate(([0], np.cumsum(each)))
        edges = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        return ids, np.diff(upto[edges])


def encoder(path: str) -> ChunkIds:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkIds(path)
    return _ENCODERS[path]


def _pieces(path: str, capacity: int, end_id: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer_file(path))
        for part in slices(batches, 1, most_bytes=2 << 20, most_rows=2_000):
            docs, texts = part.column(0), part.column(1).fill_null("")
            odd = pc.match_substring(texts, "<|")  # strings of special tokens are matched before anything is cut
            plain = pc.invert(odd)
            flat, sizes = ids.batch(texts.filter(plain))
            whole = np.empty(len(flat) + len(sizes), "<u4")
            ends = np.cumsum(sizes + 1)
            last = np.zeros(len(whole), bool)
            last[ends - 1] = True
            whole[last], whole[~last] = end_id, flat
            raw, rows = memoryview(whole.tobytes()), []
            bounds = list(zip(docs.filter(plain).to_pylist(), (ends - sizes - 1).tolist(), ends.tolist()))
            views = [(doc, raw[4 * lo:4 * hi]) for doc, lo, hi in bounds]
            end = np.array([end_id], "<u4").tobytes()
            views += [(doc, memoryview(ids.whole(t) + end)) for doc, t in zip(docs.filter(odd).to_pylist(), texts.filter(odd).to_pylist())]
            for doc, v in views:
                for k, at in enumerate(range(0, len(v) // 4, capacity)):
                    cut = v[4 * at:4 * (at + capacity)]
                    rows.append((doc, k, at, len(cut) // 4, zlib.crc32(cut)))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return pieces


def pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _pieces(tokenizer, capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- the plan -------------------------------------------------------------------
def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """min |a x - b|, x >= 0, by the active-set method of Lawson and Hanson."""
    x, passive = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        w = a.T @ (b - a @ x)
        w[passive] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= 1e-9 * scale:
            break
        passive[j] = True
        while True:
            cols = np.flatnonzero(passive)
            s = np.linalg.lstsq(a[:, cols], b, rcond=None)[0]
            if (s > 1e-12 * scale).all():
                x[:] = 0
                x[cols] = s
                break
            low = s <= 1e-12 * scale
            old = x[cols]
            step = np.min(old[low] / np.maximum(old[low] - s[low], 1e-300))
            x[cols] = old + step * (s - old)
            drop = cols[(x[cols] <= 1e-12 * scale)]
            x[drop] = 0
            passive[drop] = False
            if not len(drop):
                break
    return x


def patterns(bins: int, most: int) -> list[tuple[int, ...]]:
    """Multisets of at most ``most`` bin sizes that add up to ``bins``."""
    out: list[tuple[int, ...]] = [(bins,)]

    def grow(head: tuple[int, ...], left: int, top: int, room: int):
        if room == 1:
            if 1 <= left <= top:
                out.append((*head, left))
            return
        for b in range(min(top, left - (room - 1)), -(-left // room) - 1, -1):
            grow((*head, b), left - b, b, room - 1)

    for k in range(2, most + 1):
        grow((), bins, bins, k)
    return out


class Plan:
    """Runs (length, first rank, count, first sequence, offset) of a packing."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS, most: int = MAX_DOCS,
                 share: float = 1.0):
        self.capacity, self.share = capacity, share
        self.left = {n: c for n, c in histogram.items() if c > 0}
        self.used: dict[int, int] = dict.fromkeys(self.left, 0)
        self.groups: list[tuple[int, list[tuple[int, int]]]] = []  # sequences, [(length, first rank)]
        self._fill_patterns(bins, most)
        self._fill_rest()

    def _take(self, length: int, count: int) -> int:
        first = self.used[length]
        self.used[length] += count
        self.left[length] -= count
        return first

    def _fill_patterns(self, bins: int, most: int) -> None:
        width = -(-self.capacity // bins)
        total = self.capacity // width  # bins of a sequence
        stock: dict[int, list[int]] = {}  # bin -> lengths, longest last
        for n in sorted(self.left):
            stock.setdefault(-(-n // width), []).append(n)
        count = {b: sum(self.left[n] for n in ns) for b, ns in stock.items()}
        shapes = [p for p in patterns(total, most) if all(count.get(b) for b in p)]
        if not shapes:
            return
        a = np.zeros((total, len(shapes)))
        for j, p in enumerate(shapes):
            for b in p:
                a[b - 1, j] += 1
        x = nnls(a, np.array([count.get(b, 0) for b in range(1, total + 1)], float))
        for j in np.argsort(-x, kind="stable").tolist():
            times = int(round(self.share * float(x[j])))
            need = {b: shapes[j].count(b) for b in shapes[j]}
            times = min([times, *(count[b] // k for b, k in need.items())])
            if times <= 0:
                continue
            # the smallest document of a wider pattern is left to best fit, which knows exact lengths
            drawn = shapes[j] if len(shapes[j]) < MAX_DOCS else shapes[j][:-1]
            slots = [self._draw(stock[b], times) for b in drawn]
            for b in drawn:
                count[b] -= times
            cuts = sorted({0, times, *itertools.chain.from_iterable((s for s, _, _ in slot) for slot in slots)})
            at = [0] * len(slots)
            for lo, hi in zip(cuts, cuts[1:]):
                content = []
                for i, slot in enumerate(slots):
                    while at[i] + 1 < len(slot) and slot[at[i] + 1][0] <= lo:
                        at[i] += 1
                    s, n, r = slot[at[i]]
                    content.append((n, r + lo - s))
                self.groups.append((hi - lo, content))

    def _draw(self, lengths: list[int], times: int) -> list[tuple[int, int, int]]:
        """``times`` pieces of a bin, longest first: [(place, length, first rank)]."""
        out, at = [], 0
        while at < times:
            n = lengths[-1]
            m = min(times - at, self.left[n])
            if m:
                out.append((at, n, self._take(n, m)))
                at += m
            if not self.left[n]:
                lengths.pop()
        return out

    def _fill_rest(self) -> None:
        by_gap: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
        gaps: list[int] = []

        def put(gap: int, group) -> None:
            if gap not in by_gap:
                by_gap[gap] = []
                bisect.insort(gaps, gap)
            by_gap[gap].append(group)

        for count, content in self.groups:
            put(self.capacity - sum(n for n, _ in content), (count, content))
        for n in sorted(self.left, reverse=True):
            while self.left[n]:
                i = bisect.bisect_left(gaps, n)
                if i == len(gaps):
                    each = self.capacity // n
                    many = self.left[n] // each
                    if many:
                        put(self.capacity - each * n, (many, [(n, self._take(n, many)) for _ in range(each)]))
                    elif self.left[n]:
                        k = self.left[n]
                        put(self.capacity - k * n, (1, [(n, self._take(n, 1)) for _ in range(k)]))
                    continue
                gap = gaps[i]
                count, content = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap]
                    gaps.pop(i)
                m = min(count, self.left[n])
                if m < count:
                    put(gap, (count - m, [(k, r + m) for k, r in content]))
                put(gap - n, (m, [*content, (n, self._take(n, m))]))
        self.groups = [g for gap in gaps for g in by_gap[gap]]

    def runs(self) -> np.ndarray:
        """int64 rows (length, first rank, count, first sequence, offset), sorted."""
        out, seq = [], 0
        for count, content in self.groups:
            at = 0
            for n, r in content:
                out.append((n, r, count, seq, at))
                at += n
            seq += count
        return np.array(sorted(out), np.int64).reshape(-1, 5)

    @property
    def sequences(self) -> int:
        return sum(c for c, _ in self.groups)


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan with the fewest sequences among those that leave part of the fitted counts to best fit."""
    return min((Plan(histogram, capacity, share=s) for s in SHARES), key=lambda p: p.sequences)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, length, ...) with their sequence_id and offset."""
    salts = max(8, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = spool(cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int")))
    per = spool(cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    # at most ``capacity`` lengths, whatever the data
    histogram = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = best_plan(histogram, capacity).runs()
    keys = (runs[:, 0] << 44) + runs[:, 1]
    from pyspark.sql import Window
    before = per.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).select(
        "length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = cut.withColumn("r", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))).join(before, ["length", "salt"])

    @F.pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        if not len(n):
            return pd.DataFrame({"sequence_id": n, "offset": n})
        row = runs[np.searchsorted(keys, (n << 44) + r, side="right") - 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + r - row[:, 1], "offset": row[:, 4]})

    placed = ranked.withColumn("at", place("length", F.col("before") + F.col("r") - 1))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
