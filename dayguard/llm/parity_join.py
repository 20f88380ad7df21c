"""N-gram Jaccard self-join by parity sketches, with the components of its links.

Method
  1. A text's set: distinct word shingles, each a 64-bit hash. Texts with equal sets
     (same size, XOR and mixed sum) form one class; its smallest id stands for it.
  2. Sizes fall into bands a factor ``BAND`` wide, and a band cuts the hash space into
     cells; a cell's parity sketch is the XOR of its hashes. A linked pair differs in at
     most D members, so in at most D cells. If either set has E > D cells with members, the two
     share E - D of these sketches or more, hence one among the D + 1 first of each in any
     common order: a set gives its D + 1 least sketches, and no empty cell. Bands have cells
     enough that a set with D or fewer cells with members is rare; it gives all its cells,
     empty ones as well, and more than D there are, so two such sets share one too.
  3. Sketch rows are range-partitioned by (sketch, id), so a hot sketch is spread over
     tasks; neighbours with the same sketch become candidate pairs.
  4. Candidates must pass the size bound and a one-bit-per-token parity sketch whose
     Hamming distance is a lower bound of |A xor B|, then are verified on whole sets.
  5. Components of the verified links. Sketches that still span several components are
     shuffled and their new neighbours compared, a few times over, so that most texts of a
     group are together before any pair across is listed. Texts in sketches that span
     several components even then may have links across them. Such a pair also shares a member among the
     first |A| - ceil(t |A|) + 1 of each set in any common order; in the order of rising
     frequency those are rare, so pairs that only share a frequent passage never meet.
     These pairs are verified the same way: no link between components is lost, and
     pairs inside a component are never expanded.

Steps 1 to 5 are ``component_join``, which finds the components and only the links that
build them. ``join`` gives every link: from step 3 on all texts that share a sketch with
another go through the join on rare members of step 5, whatever their component, and all
pairs that pass the bounds are verified. Its links are the output, so a group of m
different near copies costs m (m - 1) / 2 of them.

Defined cases: null or wordless texts have an empty set and link with nothing; a text
with fewer words than a shingle is one shingle; rows with a null id are left out;
an id given twice stands for all its rows (its smallest text counts); long texts are taken whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayguard.llm.common import Scratch, mix64, ragged, slices
from dayguard.llm.common import spool as stored

BAND = 2.0
PARITY_WORDS = 16      # 64-bit words of the smallest parity sketch; larger sets have two bits a member
CACHE = 40_000         # word hashes a task keeps
SLICE_ROWS = 100       # texts a task works on at a time: the arrays made of them are many times their size
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
A_TO_Z = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FULL = 1 << 64


def spool(df: DataFrame) -> DataFrame:
    """``df`` stored; Spark drops the shuffle files of the write when it ends."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return stored(df)
    finally:
        conf.set(CLEANUP, before)


@dataclass(frozen=True)
class JoinSpec:
    """Shingle width and the threshold num / den as whole numbers."""
    width: int = 3
    num: int = 90
    den: int = 100

    def largest(self, n: int) -> int:
        return n * self.den // self.num

    def smallest(self, n: int) -> int:
        return -(-n * self.num // self.den)

    def distance(self, total: int) -> int:
        """Most |A xor B| of a linked pair with |A| + |B| = total."""
        return total * (self.den - self.num) // (self.den + self.num)

    def band_of(self, n: int) -> int:
        return int(math.log(n) / math.log(BAND) + 1e-9)

    def top(self, band: int) -> int:
        return int(math.ceil(BAND ** (band + 1)))

    def apart(self, n: int, band: int) -> int:
        """Most |A xor B| of a linked pair with |A| = n whose smaller set lies in the band."""
        return self.distance(n + (self.largest(n) if self.band_of(n) == band else min(n, self.top(band))))

    def cells(self, band: int) -> int:
        """Cells of a band: all but few of its sets have members in more of them than can differ."""
        top = self.top(band)
        least = self.distance(top + self.largest(top)) + 1
        g = least
        while 1 < g < 2 * top:
            void = math.exp(-top / g)
            if g * (1 - void) - 2 * math.sqrt(g * void * (1 - (1 + top / g) * void)) >= least:
                break
            g += 1 + g // 64
        return g

    def labels(self, n: int) -> range:
        """Bands of the smaller set of any linked pair that holds a set of size n."""
        return range(self.band_of(self.smallest(n)), self.band_of(n) + 1)


class _Known(dict):
    """Word hashes, made on first use."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Distinct shingle hashes of texts, sorted inside each; word hashes are kept between calls."""

    def __init__(self, width: int):
        self.width, self.known = width, _Known()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all texts one after the other, number of hashes of each)."""
        if len(self.known) > CACHE:
            self.known.clear()
        words = [t.encode("utf-8", "surrogatepass").translate(A_TO_Z).split() if t else [] for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        n, w = int(sizes.sum()), self.width
        h = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.uint64, n)
        made = np.where(sizes >= w, sizes - w + 1, np.minimum(sizes, 1))
        at = ragged(np.cumsum(sizes) - sizes, made)
        x = h[at]
        full = np.repeat(sizes >= w, made)
        for i in range(1, w):
            go = full | (np.repeat(sizes, made) > i)  # a shorter text is one shingle of all its words
            x = np.where(go, mix64(x) + h[np.where(go, at + i, 0)], x)
        x = mix64(x + np.where(full, 0, np.repeat(sizes, made)).astype(np.uint64))
        stops = np.cumsum(made)
        for lo, hi in zip((stops - made).tolist(), stops.tolist()):
            x[lo:hi].sort()
        doc = np.repeat(np.arange(len(texts)), made)
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
        return x[new], np.bincount(doc[new], minlength=len(texts))


def sketches(x: np.ndarray, sizes: np.ndarray, spec: JoinSpec) -> tuple[np.ndarray, np.ndarray]:
    """Cell sketches of sets (flat, sorted inside each) for every band a set can meet a partner in.

    Returns (sketches of all sets one after the other, number of sketches of each set): of each
    band the least of cells with members, one more than can differ, or every cell's where
    no more than can differ have members.
    """
    plan = {n: [(b, spec.cells(b), spec.apart(n, b)) for b in spec.labels(n)] for n in set(sizes.tolist()) if n}
    per = [plan.get(n, []) for n in sizes.tolist()]
    of = np.array([i for i, p in enumerate(per) for _ in p], np.int64)
    band, g, apart = (np.array([q[k] for p in per for q in p], np.int64) for k in range(3))
    if not len(of):
        return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
    begin = np.cumsum(sizes) - sizes
    s = x[ragged(begin[of], sizes[of])]
    reps = sizes[of]
    base = np.cumsum(g) - g
    cell = (((s >> np.uint64(32)) * np.repeat(g, reps).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    cell += np.repeat(base, reps)
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    out = np.zeros(int(g.sum()), np.uint64)
    out[cell[first]] = np.bitwise_xor.reduceat(s, first)
    part = np.repeat(np.arange(len(g)), g)
    some = np.zeros(len(out), bool)
    some[cell[first]] = True
    scarce = np.bincount(part[some], minlength=len(g)) <= apart
    at = np.flatnonzero(some | scarce[part])
    part = part[at]
    label = (at - base[part]).astype(np.uint64) + (band[part].astype(np.uint64) << np.uint64(40))
    key = mix64(out[at] ^ mix64(label)).view(np.int64)
    order = np.lexsort((key, part))
    given = np.bincount(part, minlength=len(g))
    rank = np.arange(len(order)) - np.repeat(np.cumsum(given) - given, given)
    order = order[rank < np.where(scarce, g, apart + 1)[part]]  # part is in order already
    return key[order], np.bincount(of[part[order]], minlength=len(sizes))


def parity_words(n: int) -> int:
    """Words of a set's sketch, a power of two so that sketches fold onto smaller ones."""
    return max(PARITY_WORDS, 1 << max(0, (n // 32 - 1)).bit_length())


def parities(x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each set a row of bits, one of which every member flips: (all rows' words one after
    the other, words of each, the rows folded to PARITY_WORDS words)."""
    words = np.array([parity_words(n) for n in sizes.tolist()], np.int64)
    begin = np.cumsum(words) - words
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = mix64(x ^ np.uint64(0x5bd1e995)) % (words[doc] * 64).astype(np.uint64)
    flat = np.bincount(begin[doc] * 64 + place.astype(np.int64), minlength=int(words.sum()) * 64) & 1
    rows = np.packbits(flat.astype(np.uint8), bitorder="little").view(np.int64)
    low = np.zeros((len(sizes), PARITY_WORDS), np.int64)
    if len(rows):
        col = (np.arange(len(rows)) - np.repeat(begin, words)) % PARITY_WORDS
        np.bitwise_xor.at(low, (np.repeat(np.arange(len(sizes)), words), col), rows)
    return rows, words, low


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(flat, pa.int64()))


def _summaries(spec: JoinSpec):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(spec.width)
        for part in slices(batches, 1, 1 << 20, SLICE_ROWS):
            x, sizes = shingle(part.column(1).to_pylist())
            n, some = len(sizes), sizes > 0
            begin = (np.cumsum(sizes) - sizes)[some]
            fx, fy = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            if len(x):
                fx[some] = np.bitwise_xor.reduceat(x, begin)
                fy[some] = np.add.reduceat(mix64(x ^ np.uint64(77)), begin)
            cells, made = sketches(x, sizes, spec)
            rows, words, low = parities(x, sizes)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(fx.view(np.int64)), pa.array(fy.view(np.int64)),
                 _lists(rows, words), _lists(low.reshape(-1), np.full(n, PARITY_WORDS)), _lists(cells, made)],
                names=["doc_id", "n", "x", "y", "parity", "low", "cells"])

    return summarise


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (cell, doc) rows -> rows of cells seen twice or more, each with the doc before it.

    A task's first and last rows always pass: their cell may go on in the next task.
    """
    held: tuple[int, int, int | None, bool] | None = None  # cell, doc, before, keep

    def out(c, d, p):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(p, pa.int64())],
            names=["cell", "doc", "before"])

    for batch in batches:
        cell, doc = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(cell):
            continue
        pc, pd_, first = (held[0], held[1], False) if held else (0, 0, True)
        prev = np.concatenate(([pc], cell[:-1]))
        before = np.concatenate(([pd_], doc[:-1]))
        same = cell == prev
        if first:
            same[0] = False
        if held:  # the row held back is kept if it met an equal cell on either side
            if held[3] or same[0]:
                yield out([held[0]], [held[1]], [held[2]])
        keep = same | np.append(same[1:], False)
        if first:
            keep[0] = True
        last = len(cell) - 1
        rows = np.flatnonzero(keep[:last])
        if len(rows):
            yield out(cell[rows], doc[rows], pa.array(before[rows], mask=~same[rows]))
        held = (int(cell[last]), int(doc[last]), int(before[last]) if same[last] else None, bool(keep[last]))
    if held:
        yield out([held[0]], [held[1]], [held[2]])


def _sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for part in slices(batches, 1, 1 << 20, SLICE_ROWS):
            x, sizes = shingle(part.column(1).to_pylist())
            stops = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([x[b - n:b].tobytes() for n, b in zip(sizes, stops)], pa.binary())],
                names=["doc", "members"])

    return sets


ORDER_BITS = 16  # counters that order members by frequency; any common order keeps the join exact


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << ORDER_BITS, np.int64)
    for batch in batches:
        for raw in batch.column(1).to_pylist():
            total += np.bincount((np.frombuffer(raw, np.uint64) >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["slot", "n"])


def _prefixes(spec: JoinSpec, count: np.ndarray):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(raw, np.uint64)
                order = np.lexsort((x, count[(x >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]))
                first = x[order[:len(x) - spec.smallest(len(x)) + 1]].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(np.full(len(first), doc), pa.int64())], names=["cell", "doc"])

    return prefixes


def _across(rows: DataFrame, docs: DataFrame, summary: DataFrame, spec: JoinSpec) -> tuple[DataFrame, DataFrame]:
    """(pairs that may link different roots among rows (doc, root), sets of those docs).

    Nearly all members are in one root's sets only; those go before the sketches come in, which
    are many times as wide. The size and Hamming bounds are part of the join's condition: in a
    group of copies just below the threshold only pairs that pass both leave the join.
    """
    sets = spool(docs.select(F.col("doc_id").alias("doc"), "text").join(rows.select("doc"), "doc", "left_semi")
                 .mapInArrow(_sets(spec.width), "doc bigint, members binary"))
    count = np.zeros(1 << ORDER_BITS, np.int64)
    seen = sets.mapInArrow(_frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    count[seen["slot"].to_numpy(int)] = seen["n"].to_numpy(int)  # at most 2 ** ORDER_BITS rows
    bits = [f"p{i}" for i in range(PARITY_WORDS)]
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shared = spool(_met(sets.mapInArrow(_prefixes(spec, count), "cell long, doc long"), parts, "doc").select("cell", "doc").join(rows, "doc"))
    known = summary.select(F.col("doc_id").alias("doc"), "n", *[F.col("low")[i].alias(p) for i, p in enumerate(bits)])
    first = spool(_across_roots(shared).withColumnRenamed("cell", "member").join(known, "doc"))
    l, r = first.alias("l"), first.select(*[F.col(c).alias(f"{c}_") for c in first.columns])
    far = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}_"))) for p in bits), F.lit(0))
    pairs = l.join(r, (F.col("member") == F.col("member_")) & (F.col("doc") < F.col("doc_")) & (F.col("root") != F.col("root_"))
                   & (spec.den * F.least("n", "n_") >= spec.num * F.greatest("n", "n_"))
                   & ((spec.den + spec.num) * far <= (spec.den - spec.num) * (F.col("n") + F.col("n_"))))
    return pairs.select(F.col("doc").alias("a"), F.col("doc_").alias("b")).distinct(), sets


def _linked(spec: JoinSpec):
    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.searchsorted(x, y)
            both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
            return spec.den * both >= spec.num * (len(x) + len(y) - both)
        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=bool)

    return linked


def _promising(pairs: DataFrame, summary: DataFrame, spec: JoinSpec) -> DataFrame:
    """Pairs (a < b) that pass the size bound and the Hamming bound."""
    side = lambda c: summary.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"),
                                    F.col("parity").alias(f"p_{c}"))
    half = lambda c: F.zip_with(F.slice(c, F.lit(1), (F.size(c) / 2).cast("int")),
                                F.slice(c, (F.size(c) / 2).cast("int") + 1, (F.size(c) / 2).cast("int")), lambda u, v: u.bitwiseXOR(v))
    even = lambda c, d: F.when(F.size(c) > F.size(d), half(c)).otherwise(F.col(c))
    # sizes within the bound differ by less than a factor of two, so one fold makes sketches equally long
    far = F.aggregate(F.zip_with(even("p_a", "p_b"), even("p_b", "p_a"), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, v: s + v)
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(spec.den * F.least("n_a", "n_b") >= spec.num * F.greatest("n_a", "n_b"))
            .where(((spec.den + spec.num) * far <= (spec.den - spec.num) * (F.col("n_a") + F.col("n_b"))))
            .select("a", "b"))


def _sets_of(pairs: DataFrame, docs: DataFrame, spec: JoinSpec) -> DataFrame:
    texts = docs.select(F.col("doc_id").alias("doc"), "text").join(_ends(pairs), "doc", "left_semi")
    return spool(texts.mapInArrow(_sets(spec.width), "doc bigint, members binary"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, spec: JoinSpec) -> DataFrame:
    return (pairs.join(sets.select(F.col("doc").alias("a"), F.col("members").alias("s_a")), "a")
            .join(sets.select(F.col("doc").alias("b"), F.col("members").alias("s_b")), "b")
            .where(_linked(spec)("s_a", "s_b")).select("a", "b"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each node of the edges reaches.

    Every round points each node at its smallest neighbour, shortens the pointers and
    contracts the edges to the roots; only edges between different roots go on. Repeated
    edges are left in: they never outnumber the given ones and the minimum is partial.
    """
    left = spool(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b"))
    roots: DataFrame | None = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        point = spool(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                      .select("node", F.least("node", "m").alias("root")))
        while True:
            up = point.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = spool(point.join(up, "root", "left").select(
                "node", F.coalesce("top", "root").alias("root"), (F.col("top") != F.col("root")).alias("moved")))
            point = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if roots is None:
            roots = point
        else:
            later = point.select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = spool(roots.join(later, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
        ra = point.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = point.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = spool(left.join(ra, "a").join(rb, "b").where("ra <> rb")
                     .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")))
    if roots is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def merged(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further edges (a, b): only the edges' roots are joined anew."""
    ra, rb = (roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b"))
    upper = components(edges.join(ra, "a", "left").join(rb, "b", "left")
                       .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    top = upper.select(F.col("node").alias("root"), F.col("root").alias("top"))
    new = upper.join(roots.select("node"), "node", "left_anti")
    return spool(roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")).union(new))


def _settled(pairs: DataFrame, sets: DataFrame, known: tuple[DataFrame, DataFrame] | None,
             spec: JoinSpec) -> tuple[DataFrame, DataFrame]:
    """(links, roots), on top of those known, after the pairs are verified as far as they matter.

    First each document's pair with its smallest partner, so a set moves about once however
    many partners it has; then the pairs whose ends are still in different components.
    """
    first = spool(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    found = spool(_verified(first, sets, spec))
    links = known[0].union(found) if known else found
    roots = merged(known[1], found) if known else components(found)
    ra, rb = (roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b"))
    rest = spool(pairs.join(first, ["a", "b"], "left_anti").join(ra, "a", "left").join(rb, "b", "left")
                 .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"))
    if not rest.isEmpty():
        found = spool(_verified(rest, sets.join(_ends(rest), "doc", "left_semi"), spec))
        links, roots = links.union(found), merged(roots, found)
    return links, roots


def _sketched(docs: DataFrame, spec: JoinSpec, id_col: str, text_col: str):
    """Steps 1 to 3: (docs, info of all ids, classes, summaries of their representatives, rows that share a cell)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    scratch = Scratch(spark)
    wide = scratch.spool(docs.mapInArrow(_summaries(spec), "doc_id long, n long, x long, y long, parity array<long>, low array<long>, cells array<long>"), "wide")
    info = spool(wide.select("doc_id", "n", "x", "y"))
    reps = spool(info.where("n > 0").groupBy("n", "x", "y").agg(F.min("doc_id").alias("class_id"),
                                                                F.count(F.lit(1)).alias("copies")))
    only = reps.select(F.col("class_id").alias("doc_id"))
    summary = spool(wide.where("n > 0").select("doc_id", "n", "parity", "low").join(only, "doc_id", "left_semi"))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the same plan at any size: a table that is broadcast while it is small moves out of step with the input
    cells = wide.where("n > 0").select("doc_id", "cells").join(only.hint("merge"), "doc_id", "left_semi")
    met = spool(_met(cells.select(F.explode("cells").alias("cell"), F.col("doc_id").alias("doc")), parts, "doc"))
    scratch.remove("wide")
    return docs, info, reps, summary, met


def _met(rows: DataFrame, parts: int, order) -> DataFrame:
    """Rows (cell, doc) of cells seen twice or more, each with the doc before it in the order given."""
    return (rows.repartitionByRange(parts, "cell", order).sortWithinPartitions("cell", order)
            .select("cell", "doc").mapInArrow(_neighbours, "cell long, doc long, before long"))


def _members(info: DataFrame, reps: DataFrame, roots: DataFrame) -> DataFrame:
    return (info.where("n > 0").join(reps, ["n", "x", "y"])
            .select("doc_id", F.col("n").alias("n_shingles"), "class_id", "copies")
            .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
            .select("doc_id", "n_shingles", "class_id", F.coalesce("root", "class_id").alias("component_id"))
            .union(info.where("n = 0").select("doc_id", F.lit(0).cast("long"), "doc_id", "doc_id")))


def join(docs: DataFrame, spec: JoinSpec = JoinSpec(), *, id_col: str = "doc_id", text_col: str = "text"):
    """(members, links): members has doc_id, n_shingles, class_id, component_id, n_links for every
    document; links all pairs (a < b) of class representatives that reach the threshold.

    ``n_links`` counts the different texts that a document's text links with.
    """
    docs, info, reps, summary, met = _sketched(docs, spec, id_col, text_col)
    rows = spool(met.select("doc").distinct().withColumn("root", F.col("doc")))  # each its own root: no pair is left out
    pairs, sets = _across(rows, docs, summary, spec)
    links = spool(_verified(spool(_promising(pairs, summary, spec)), sets, spec))
    n_links = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    members = _members(info, reps, components(links)).join(n_links, "class_id", "left").select(
        "doc_id", "n_shingles", "class_id", "component_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    return members, links


SHUFFLES = 4  # further orders in which a cell's neighbours are compared


def _across_roots(rows: DataFrame) -> DataFrame:
    """The rows (cell, root, ...) of cells with several roots."""
    mixed = rows.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("cell")
    return rows.join(mixed, "cell", "left_semi")


def _mixed(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, doc, root) of the cells whose texts are still in several components."""
    return spool(_across_roots(spool(rows.distinct().join(roots.withColumnRenamed("node", "doc"), "doc", "left").select(
        "cell", "doc", F.coalesce("root", "doc").alias("root")))))


def component_join(docs: DataFrame, spec: JoinSpec = JoinSpec(), *, id_col: str = "doc_id", text_col: str = "text"):
    """(members, links): members has doc_id, n_shingles, class_id, component_id for every
    document; links only the verified pairs (a < b) between class representatives that build components."""
    docs, info, reps, summary, met = _sketched(docs, spec, id_col, text_col)
    near = met.where("before IS NOT NULL AND before <> doc").select(
        F.least("before", "doc").alias("a"), F.greatest("before", "doc").alias("b")).distinct()
    close = spool(_promising(near, summary, spec))
    links, roots = _settled(close, _sets_of(close, docs, spec), None, spec)
    rows = _mixed(met.select("cell", "doc"), roots)
    # other neighbours first: texts that link anyway are in one component before pairs are listed
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for salt in range(SHUFFLES):
        if rows.isEmpty():
            break
        order = F.xxhash64("doc", F.lit(salt))
        met = _met(rows.select("cell", "doc"), parts, order).where("before IS NOT NULL AND before <> doc")
        ra, rb = (rows.select(F.col("doc").alias(c), F.col("root").alias(f"root_{c}")).distinct() for c in ("before", "doc"))
        more = spool(met.join(ra, "before").join(rb, "doc").where("root_before <> root_doc").select(
            F.least("before", "doc").alias("a"), F.greatest("before", "doc").alias("b")).distinct())
        more = spool(_promising(more.join(near, ["a", "b"], "left_anti"), summary, spec))
        if more.isEmpty():
            break
        links, roots = _settled(more, _sets_of(more, docs, spec), (links, roots), spec)
        near = spool(near.union(more))
        rows = _mixed(rows.select("cell", "doc"), roots)
    if not rows.isEmpty():
        rows = spool(rows.select("doc", "root").distinct())
        pairs, sets = _across(rows, docs, summary, spec)
        cross = spool(_promising(pairs.join(near, ["a", "b"], "left_anti"), summary, spec))
        if not cross.isEmpty():
            sets = spool(sets.join(_ends(cross), "doc", "left_semi"))  # few of them, so only these are moved
            links, roots = _settled(cross, sets, (links, roots), spec)
    return _members(info, reps, roots), links
