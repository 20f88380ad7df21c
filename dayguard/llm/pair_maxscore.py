"""Ranked lexical search: MaxScore with bounds for term pairs.

An item's terms are scored over blocks of documents. MaxScore skips what cannot reach the
tenth best score by the sum of the terms' largest impacts; two heavy terms rarely meet in one
document, so here chosen pairs of an item's terms have an intersection list with the largest
joint impact, and a pair's bound is max(largest a, largest b, largest a + b of a shared
document) instead of the sum. At query time the pairs that tighten most, each term in one pair at
most, are combined with the other terms' own maxima.

1. ``postings``: one pass over the documents writes blocks of at most BLOCK_DOCS documents
   with the postings of the items' terms (in document order), lengths and counts. No shuffle.
2. ``index``: impacts from the corpus counts; per block and chosen pair the intersection list
   and its joint maximum; per item the best joint impacts, which are scores that documents
   reach at least, so the tenth best over all blocks is a first threshold.
3. ``search``: per block and item, skip the block by the combined bound; else score the
   documents of the groups that can matter and look up the rest only for documents still in
   the race. Each task returns ten documents an item at most; a window ranks them.

Items are taken ITEMS_AT_ONCE at a time (a stated query set), so what tasks carry is bounded
by the items' texts; documents are never collected.

Defined cases: null text has no terms; a document without terms counts in nothing; a null
doc_id is last among equals; rows of one doc_id are documents of their own; rows of one
item_id (null too) are one item with the terms of all; items without terms or with a null
text only have no result; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayguard.llm.common import slices, spool

BLOCK_DOCS = 4096
BLOCK_POSTINGS = 2_000_000
ITEMS_AT_ONCE = 2000
HEAVY = 8  # terms of an item that are paired with each other; the rest are paired in order of weight
# fixed values of the score
K1_SCALE, LENGTH_SHARE, FULL, TF_SCALE = 8, 90, 100, 1_000_000_000
# every byte that is no part of a term becomes a space; A-Z become a-z
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split()


@dataclass
class Items:
    """Some items: ids, their terms as numbers, and the chosen pairs."""

    ids: list
    terms: list          # per item: sorted term numbers
    vocabulary: dict     # term -> number


def read_items(rows) -> Items:
    by: dict = {}
    for r in rows:
        by.setdefault(r["item_id"], set()).update(words(r["text"]) if r["text"] is not None else ())
    vocabulary: dict = {}
    for terms in by.values():
        for w in sorted(terms):
            vocabulary.setdefault(w, len(vocabulary))
    return Items(list(by), [sorted(vocabulary[w] for w in t) for t in by.values()], vocabulary)


BLOCK = ("doc_id array<long>, words array<long>, term array<int>, df array<int>, doc array<int>, tf array<int>, "
         "n_docs long, n_words long")


def postings(docs: DataFrame, items: Items, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Blocks of documents with the postings of the items' terms."""
    known = items.vocabulary

    def close(rows, n_docs, n_words):
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0))  # positions follow doc_id
        term = np.concatenate([r[2] for r in rows]) if rows else np.empty(0, np.int32)
        tf = np.concatenate([r[3] for r in rows]) if rows else np.empty(0, np.int32)
        doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) for r in rows])
        order = np.argsort(term, kind="stable")
        which, df = np.unique(term, return_counts=True)
        cols = [[r[0] for r in rows], [r[1] for r in rows], which, df, doc[order], tf[order]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
        arrays = [pa.array([c], pa.list_(k)) for c, k in zip(cols, kinds)] + [pa.array([n_docs]), pa.array([n_words])]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, n_docs, n_words = [], 0, 0, 0
        for b in slices(batches, 1):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = words(text) if text else []
                if not found:
                    continue
                n_docs, n_words = n_docs + 1, n_words + len(found)
                mine = [(known[w], n) for w, n in Counter(found).items() if w in known]
                if mine:
                    t, tf = zip(*mine)
                    rows.append((doc_id, len(found), np.array(t, np.int32), np.array(tf, np.int32)))
                    held += len(t)
                if len(rows) >= block_docs or held >= BLOCK_POSTINGS:
                    yield close(rows, n_docs, n_words)
                    rows, held, n_docs, n_words = [], 0, 0, 0
        if n_docs:
            yield close(rows, n_docs, n_words)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCK)


@dataclass
class Stats:
    n_docs: int
    n_words: int
    weight: np.ndarray  # per term number


def statistics(blocks: DataFrame, items: Items) -> Stats:
    """Corpus counts of the posted terms (one row per term reaches the driver)."""
    n, words_ = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    df = np.zeros(len(items.vocabulary), dtype=np.int64)
    each = blocks.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy("x.term").agg(F.sum("x.df").alias("df"))
    for r in each.collect():
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    return Stats(n, words_, weight)


def chosen_pairs(items: Items, stats: Stats, heavy: int = HEAVY) -> list[list[tuple[int, int]]]:
    """Pairs with an intersection list, per item: all among the heaviest terms, and the rest
    two by two in order of weight."""
    out = []
    for terms in items.terms:
        t = sorted(terms, key=lambda x: (-stats.weight[x], x))
        top, rest = t[:heavy], t[heavy:]
        pairs = [(a, b) for i, a in enumerate(top) for b in top[i + 1:]] + list(zip(rest[::2], rest[1::2]))
        out.append([(min(p), max(p)) for p in pairs])
    return out


def impacts(weight, tf, n, stats: Stats):
    """Share of a term in a document's score (64-bit integers, rounded down)."""
    m = FULL - LENGTH_SHARE + (LENGTH_SHARE * n * stats.n_docs) // max(stats.n_words, 1)
    return weight * ((TF_SCALE * tf) // (1000 * tf + K1_SCALE * m))


INDEX = ("doc_id array<long>, term array<int>, df array<int>, doc array<int>, impact array<long>, largest array<long>, "
         "pair array<int>, joint array<long>, shared array<int>, pair_doc array<int>, pair_impact array<long>, "
         "seed_item array<int>, seed array<long>")


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest, equal ones by position."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((at, -scores[at]))][:k]


def index(blocks: DataFrame, items: Items, stats: Stats, k: int) -> tuple[DataFrame, list]:
    """Blocks with impacts, largest impacts, intersection lists and first scores; the pairs."""
    chosen = chosen_pairs(items, stats)
    pairs = sorted({p for each in chosen for p in each})
    number = {p: i for i, p in enumerate(pairs)}
    lists = [[number[p] for p in each] for each in chosen]
    schema = pa.schema([(x.split()[0], pa.list_(pa.int32() if "<int>" in x else pa.int64())) for x in INDEX.split(", ")])

    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                get = lambda c: b.column(c)[row].values  # noqa: E731,B023
                n = get("words").to_numpy(zero_copy_only=False)
                term, df = (get(c).to_numpy(zero_copy_only=False) for c in ("term", "df"))
                doc, tf = (get(c).to_numpy(zero_copy_only=False) for c in ("doc", "tf"))
                value = impacts(np.repeat(stats.weight[term], df), tf.astype(np.int64), n[doc], stats)
                at = np.concatenate(([0], np.cumsum(df)))
                place = {t: i for i, t in enumerate(term.tolist())}
                largest = np.maximum.reduceat(value, at[:-1]) if len(term) else np.empty(0, np.int64)
                held, joint, shared, found = [], [], [], {}
                side = np.zeros(len(n), dtype=np.int64)
                for p, (a, c) in enumerate(pairs):
                    i, j = place.get(a), place.get(c)
                    if i is None or j is None:
                        continue
                    if df[i] > df[j]:
                        i, j = j, i
                    x, y = slice(at[i], at[i + 1]), slice(at[j], at[j + 1])
                    side[doc[x]] = value[x]
                    other = side[doc[y]]
                    both = other > 0
                    found[p] = doc[y][both], (other + value[y])[both]
                    side[doc[x]] = 0
                    held.append(p)
                    shared.append(int(both.sum()))
                    joint.append(int(found[p][1].max()) if shared[-1] else 0)
                seeds, seed_of = [], []
                for item, mine in enumerate(lists):
                    here = [found[p] for p in mine if p in found and len(found[p][0])]
                    if here:
                        d, s = np.concatenate([x[0] for x in here]), np.concatenate([x[1] for x in here])
                        order = np.lexsort((-s, d))
                        d, s = d[order], s[order]
                        s = s[np.concatenate(([True], d[1:] != d[:-1]))]  # a document's best pair
                        s = s[best(s, k)]
                        seeds += s.tolist()
                        seed_of += [item] * len(s)
                cat = lambda i, t: np.concatenate([found[p][i] for p in held]) if held else np.empty(0, t)  # noqa: E731,B023
                cols = [get("doc_id"), term, df, doc, value, largest, held, joint, shared, cat(0, np.int32), cat(1, np.int64), seed_of, seeds]
                yield pa.RecordBatch.from_arrays([pa.array([c.to_pylist() if isinstance(c, pa.Array) else c], f.type)
                                                  for c, f in zip(cols, schema)], schema=schema)

    return blocks.mapInArrow(run, INDEX), pairs


def first_thresholds(idx: DataFrame, items: Items, k: int) -> np.ndarray:
    """Per item a score that k documents reach (0 where pairs give fewer)."""
    s = idx.select(F.explode(F.arrays_zip("seed_item", "seed")).alias("x")).select("x.seed_item", "x.seed")
    w = Window.partitionBy("seed_item").orderBy(F.desc("seed"))
    top = s.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).groupBy("seed_item").agg(
        F.min("seed").alias("low"), F.count(F.lit(1)).alias("n"))
    out = np.zeros(len(items.ids), dtype=np.int64)
    for r in top.where(F.col("n") == k).collect():  # one row an item
        out[r["seed_item"]] = r["low"]
    return out


def bound_groups(terms: list[int], largest: dict[int, int], pairs: list[tuple[int, int, int]]) -> list[tuple[int, tuple]]:
    """Terms in groups of one or two with the groups' bounds, smallest first. ``pairs`` are
    (a, b, joint maximum); those that save most against the sum of two maxima are taken first."""
    gain = sorted(((min(largest[a], largest[b], largest[a] + largest[b] - j), a, b, j) for a, b, j in pairs), reverse=True)
    used, out = set(), []
    for g, a, b, j in gain:
        if g > 0 and a not in used and b not in used:
            used |= {a, b}
            out.append((max(largest[a], largest[b], j), (a, b)))
    return sorted(out + [(largest[t], (t,)) for t in terms if t not in used])


class BlockIndex:
    """One block: postings and pair maxima by number."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda c: batch.column(c)[row].values
        self.doc_id = get("doc_id")
        df = get("df").to_numpy(zero_copy_only=False)
        at = np.concatenate(([0], np.cumsum(df)))
        doc, impact = get("doc").to_numpy(zero_copy_only=False), get("impact").to_numpy(zero_copy_only=False)
        self.lists = {t: (doc[at[i]:at[i + 1]], impact[at[i]:at[i + 1]]) for i, t in enumerate(get("term").to_pylist())}
        self.largest = dict(zip(get("term").to_pylist(), get("largest").to_pylist()))
        self.joint = dict(zip(get("pair").to_pylist(), get("joint").to_pylist()))
        self.skipped = self.scored = 0

    def top(self, terms, pairs, threshold: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of documents that may be among the k best, at least all that
        reach ``threshold`` and are; positions and scores are exact for those returned."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        here = [t for t in terms if t in self.lists]
        if not here:
            return none
        groups = bound_groups(here, self.largest, [(a, b, self.joint[p]) for p, a, b in pairs if p in self.joint])
        below = np.cumsum([g[0] for g in groups])
        if below[-1] < threshold:
            self.skipped += 1
            return none
        needed = int(np.searchsorted(below, threshold))  # groups before it cannot reach it alone
        if threshold <= 0:
            needed = 0
        score = np.zeros(len(self.doc_id), dtype=np.int64)
        for _, group in groups[needed:]:
            for t in group:
                doc, impact = self.lists[t]
                score[doc] += impact
        rest = int(below[needed - 1]) if needed else 0
        cand = np.flatnonzero(score)
        cand = cand[score[cand] + rest >= threshold]
        for i in range(needed - 1, -1, -1):
            if not len(cand):
                return none
            for t in groups[i][1]:
                doc, impact = self.lists[t]
                where = np.searchsorted(doc, cand)
                hit = where < len(doc)
                hit[hit] = doc[where[hit]] == cand[hit]
                score[cand[hit]] += impact[where[hit]]
            rest = int(below[i - 1]) if i else 0
            cand = cand[score[cand] + rest >= threshold]
        self.scored += len(cand)
        keep = best(score[cand], k)
        return cand[keep], score[cand[keep]]


FOUND = "item int, doc_id long, score long"


def ranked(docs: DataFrame, items: Items, k: int = 10, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item (number), rank, doc_id, score of the k best documents of each of ``items``."""
    blocks = spool(postings(docs, items, block_docs))
    stats = statistics(blocks, items)
    made, pairs = index(blocks, items, stats, k)
    made = spool(made)
    start = first_thresholds(made, items, k)
    number = {p: i for i, p in enumerate(pairs)}
    plan = [(t, [(number[p], *p) for p in each]) for t, each in zip(items.terms, chosen_pairs(items, stats))]
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)

    def run(batches):
        mine: list = [[] for _ in plan]
        limit = start.copy()
        for b in batches:
            for row in range(b.num_rows):
                block = BlockIndex(b, row)
                for i, (terms, pairs_) in enumerate(plan):
                    at, score = block.top(terms, pairs_, int(limit[i]), k)
                    if len(at):
                        ids = block.doc_id.take(pa.array(at)).to_pylist()
                        mine[i] = sorted([*mine[i], *zip(score.tolist(), ids)], key=order)[:k]
                        if len(mine[i]) == k:
                            limit[i] = max(limit[i], mine[i][-1][0])
        rows = [(i, d, s) for i, found in enumerate(mine) for s, d in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64()))],
                                             names=["item", "doc_id", "score"])

    columns = ("doc_id", "term", "df", "doc", "impact", "largest", "pair", "joint")
    found = made.select(*columns).mapInArrow(run, FOUND)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, at_once: int = ITEMS_AT_ONCE, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every query (item_id, text)."""
    spark = docs.sparkSession
    q = queries.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id")
    out, part, last = None, [], object()

    def add(out, rows):
        items = read_items(rows)
        if not items.vocabulary:
            return out
        ids = spark.createDataFrame([(i, x) for i, x in enumerate(items.ids)], "item int, item_id long")
        r = ranked(docs, items, k, block_docs).join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        return r if out is None else out.unionByName(r)

    for row in q.toLocalIterator():  # the stated queries, in blocks
        if len(part) >= at_once and row["item_id"] != last:
            out, part = add(out, part), []
        part.append(row)
        last = row["item_id"]
    out = add(out, part)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
