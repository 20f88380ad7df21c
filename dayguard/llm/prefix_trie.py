"""Conversation prefix trie by range minimum over sorted longest common prefixes.

Conversations are sequences of turn digests. In sorted order every trie node (a distinct
prefix of d turns) is an interval of neighbours whose adjacent common prefixes are d or
more, so a sparse table of range minima over those lengths gives a prefix its members: from
any member one binary search finds the left end and another the right end, each prefix on
its own, without a stack. Nodes listed by (first member, depth) are in preorder, so subtree
totals are differences of running sums, and smallest members a range minimum.

Plan for any number of conversations:
1. equal conversations become one row (digests, code points, count, smallest id, hash of the
   ids). Ids are gathered per ID_RANGE ids at most and streamed through the hash in order, so
   a huge group of copies is never in memory;
2. range sort; each task cuts its sorted rows into blocks of at most BLOCK_ROWS rows (and
   some BLOCK_TURNS turns) and solves each block alone. Only nodes on the path of a block's
   first or last row can have members in other blocks; all others are final;
3. these two paths per block, carrying the totals of what hangs off them, are the next
   level's rows. Each level is smaller by half a block, until one block holds all;
4. a final node whose parent lay on such a path gets the parent's id by a join on the
   parent's prefix digest.

Defined cases: null turns come first, equal turns are ordered by digest; null role or text
is empty; repeated rows are turns like others; rows with a null conv_id belong to no
conversation; a conversation may be left without turns and is then a member of the root
alone; an empty table has no nodes; other columns are ignored. A conversation's digests (24
bytes a turn) are one row, its texts never leave their rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayguard.llm.common import ragged, spool

ID_RANGE = 8192        # ids whose copies are joined into one string
BLOCK_ROWS = 4096      # sorted rows solved at once
BLOCK_TURNS = 500_000  # turns at which a block of four rows or more is closed
EMPTY_SHA = hashlib.sha256().hexdigest()
NONE = np.iinfo(np.int64).max  # smallest id of no member


# --- sequences ------------------------------------------------------------------
def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, seq: array of (g: 16-byte digest of role and text, c: code points of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = F.struct(F.col("turn"), F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("g"),
                   F.length(text).cast("long").alias("c"))
    t = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t"))
    return t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["g"].alias("g"), x["c"].alias("c"))).alias("seq"))


def shared_heads(seqs: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Conversations rebuilt on a common head: the first h turns (crc32 of the id modulo
    most + 1) come from the conversation that opens the id's hundred, the rest is its own."""
    heads = seqs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    own = seqs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h)
    head = F.slice(F.coalesce("head", F.slice("seq", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("seq"))


ROW = ("key array<binary>, chars array<long>, n array<long>, least array<long>, leaves array<long>, saved array<long>, "
       "kids array<long>, ends array<string>")
NODE = ("own binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "array<binary>": pa.list_(pa.binary()),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in ddl.split(", ")])


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sk, key, chars, n, least, ids) in order of (sk, ids) -> one row per sequence; what
    a sequence has of its own stands at its last depth."""
    schema = _arrow(ROW)
    now, done = None, []

    def closed(x):
        sk, key, chars, n, least, sha = x
        zero = [0] * len(key)
        return [key, chars, [*zero, n], [*[NONE] * len(key), least], [*zero, 0], [*zero, 0], [*zero, 0],
                [*[None] * len(key), sha.hexdigest()]]

    for b in batches:
        for sk, key, chars, n, least, ids in zip(*[c.to_pylist() for c in b.columns]):
            if now is None or now[0] != sk:
                done += [closed(now)] if now else []
                now = [sk, key, chars, 0, least, hashlib.sha256()]
            else:
                now[5].update(b",")
            now[3] += n
            now[4] = min(now[4], least)
            now[5].update(ids.encode())
        if done:
            yield _batch(done, schema)
            done = []
    if now:
        yield _batch([closed(now)], schema)


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """One row per distinct sequence, in the form of a level's rows."""
    key, chars = F.transform("seq", lambda x: x["g"]), F.transform("seq", lambda x: x["c"])
    s = seqs.select("conv_id", key.alias("key"), chars.alias("chars"), F.floor(F.col("conv_id") / ID_RANGE).alias("part"))
    s = s.withColumn("sk", F.unhex(F.md5(F.array_join(F.transform("key", F.hex), ""))))
    ids = F.sort_array(F.collect_list("conv_id"))  # at most ID_RANGE of them
    g = s.groupBy("sk", "part").agg(F.first("key").alias("key"), F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n"),
                                    F.min("conv_id").alias("least"), ids.alias("ids"))
    g = g.repartition("sk").sortWithinPartitions("sk", "part")
    return g.select("sk", "key", "chars", "n", "least", F.array_join("ids", ",").alias("ids")).mapInArrow(_distinct, ROW)


# --- range minimum --------------------------------------------------------------
class RangeMin:
    """Sparse table: level k holds the minima of all stretches of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values)]
        while 2 ** len(self.levels) <= len(values):
            half = 2 ** (len(self.levels) - 1)
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of values[lo:hi] (hi over lo)."""
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=self.levels[0].dtype)
        for j in np.unique(k):
            at = k == j
            out[at] = np.minimum(self.levels[j][lo[at]], self.levels[j][hi[at] - 2 ** int(j)])
        return out

    def reach_right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last row r with all values at + 1 .. r of ``depth`` or more."""
        r, n = at.copy(), len(self.levels[0])
        for j in reversed(range(len(self.levels))):
            t = self.levels[j]
            ok = r + 2 ** j < n
            ok[ok] = t[r[ok] + 1] >= depth[ok]
            r[ok] += 2 ** j
        return r

    def reach_left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First row l with all values l + 1 .. at of ``depth`` or more."""
        left = at.copy()
        for j in reversed(range(len(self.levels))):
            t, step = self.levels[j], 2 ** j
            ok = left - step >= 0
            ok[ok] = t[left[ok] - step + 1] >= depth[ok]
            left[ok] -= step
        return left


def common_prefixes(lengths: np.ndarray, starts: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Turns that row i shares with row i - 1 (-1 for row 0, so that even the root starts there)."""
    m = len(lengths)
    out = np.zeros(m, dtype=np.int64)
    most = np.minimum(lengths[1:], lengths[:-1])
    alive, d = np.flatnonzero(most > 0), 0
    while len(alive):
        alive = alive[(digests[starts[alive] + d] == digests[starts[alive + 1] + d]).all(axis=1)]
        d += 1
        out[alive + 1] = d
        alive = alive[most[alive] > d]
    out[0] = -1
    return out


# --- one block ------------------------------------------------------------------
class Block:
    """Sorted distinct rows and the trie nodes among them."""

    def __init__(self, table: pa.Table):
        col = {n: table.column(n).combine_chunks() for n in table.column_names}
        flat = {n: c.flatten() for n, c in col.items()}
        number = lambda n: flat[n].to_numpy(zero_copy_only=False).astype(np.int64)
        self.m = table.num_rows
        self.L = np.asarray(col["key"].value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.L)[:-1]))
        raw = b"".join(flat["key"].to_pylist())
        self.digests = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 16).view(np.uint64)
        self.chars = number("chars")
        self.lcp = common_prefixes(self.L, self.start, self.digests)
        self.range = RangeMin(self.lcp)
        # nodes: (row, depth) for the depths that row shares with no earlier row
        count = self.L - self.lcp
        self.first = np.concatenate(([0], np.cumsum(count)))
        self.row = np.repeat(np.arange(self.m), count)
        self.depth = ragged(self.lcp + 1, count)
        self.left = self.range.reach_left(self.row, self.depth)
        self.right = self.range.reach_right(self.row, self.depth)
        up = np.maximum(self.depth - 1, 0)
        self.parent = np.where(self.depth > 0, self.node(self.range.reach_left(self.row, up), up), -1)
        self.end = self.first[self.right + 1]
        # what the rows bring along, at their prefixes' nodes
        slots = self.L + 1
        r, d = np.repeat(np.arange(self.m), slots), ragged(np.zeros(self.m, dtype=np.int64), slots)
        at = self.node(self.range.reach_left(r, d), d)
        size = len(self.row)
        self.brought = {}
        for name in ("n", "leaves", "saved", "kids"):
            self.brought[name] = np.zeros(size, dtype=np.int64)
            np.add.at(self.brought[name], at, number(name))
        self.brought["least"] = np.full(size, NONE)
        np.minimum.at(self.brought["least"], at, number("least"))
        ends = flat["ends"]
        held = np.flatnonzero(ends.is_valid().to_numpy(zero_copy_only=False))
        self.ends = dict(zip(at[held].tolist(), ends.take(pa.array(held)).to_pylist()))
        # totals of subtrees
        here = np.arange(size)
        total = lambda x: (lambda c: c[self.end] - c[here])(np.concatenate(([0], np.cumsum(x))))
        self.n = total(self.brought["n"])
        self.least = RangeMin(self.brought["least"]).least(here, self.end)
        inner = self.parent >= 0
        self.kids = self.brought["kids"] + np.bincount(self.parent[inner], minlength=size)
        last = np.where(self.depth > 0, self.chars[self.start[self.row] + np.maximum(self.depth - 1, 0)]
                        if len(self.chars) else 0, 0)
        self.leaves = total(self.brought["leaves"] + (self.kids == 0))
        self.saved = total(self.brought["saved"] + (self.n - 1) * last)

    def node(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Node of a prefix that starts at ``row``."""
        return self.first[row] + depth - self.lcp[row] - 1

    def path(self, row: int) -> np.ndarray:
        """Nodes of all prefixes of a row, from the root."""
        d = np.arange(self.L[row] + 1)
        return self.node(self.range.reach_left(np.full(len(d), row), d), d)

    def prefix_digests(self, row: int) -> list[bytes]:
        h, out = hashlib.md5(), []
        out.append(h.digest())
        for x in self.digests[self.start[row]:self.start[row] + self.L[row]]:
            h.update(x.tobytes())
            out.append(h.digest())
        return out

    def finals(self, keep: np.ndarray, named: dict[int, bytes], own: dict[int, bytes]) -> list:
        """Columns of the nodes ``keep``; ``named``: parents that are not settled here."""
        parent = self.parent[keep]
        known = np.array([p >= 0 and p not in named for p in parent.tolist()], dtype=bool)
        ids = np.where(known, self.least[np.maximum(parent, 0)], 0)
        return [[own.get(i) for i in keep.tolist()], [named.get(p) for p in parent.tolist()], self.least[keep],
                self.depth[keep], pa.array(ids, mask=~known), self.n[keep], self.kids[keep], self.leaves[keep],
                self.saved[keep], [self.ends.get(i, EMPTY_SHA) for i in keep.tolist()]]

    def open_rows(self) -> tuple[np.ndarray, list, dict[int, bytes]]:
        """(nodes on the two outer paths, rows of the next level, their prefix digests)."""
        rows = [0] if self.m == 1 else [0, self.m - 1]
        on, names, seen = np.zeros(len(self.row), dtype=bool), {}, set()
        paths = [self.path(r) for r in rows]
        for r, p in zip(rows, paths):
            on[p] = True
            names |= dict(zip(p.tolist(), self.prefix_digests(r)))
        hang = np.flatnonzero(~on & (self.parent >= 0))
        hang = hang[on[self.parent[hang]]]  # settled subtrees that hang off the paths
        sums = {"n": self.n, "leaves": self.leaves, "saved": self.saved, "kids": np.ones(len(self.row), dtype=np.int64)}
        got = {k: self.brought[k].copy() for k in self.brought}
        for k, v in sums.items():
            np.add.at(got[k], self.parent[hang], v[hang])
        np.minimum.at(got["least"], self.parent[hang], self.least[hang])
        out = []
        for r, p in zip(rows, paths):
            new = np.array([i not in seen for i in p.tolist()])
            seen |= set(p.tolist())
            s = slice(self.start[r], self.start[r] + self.L[r])
            digests = [x.tobytes() for x in self.digests[s]]
            val = {k: np.where(new, got[k][p], NONE if k == "least" else 0).tolist() for k in got}
            ends = [self.ends.get(i) if f else None for i, f in zip(p.tolist(), new)]
            out.append([digests, self.chars[s].tolist(), val["n"], val["least"], val["leaves"], val["saved"], val["kids"], ends])
        return on, out, names


LEVEL = NODE + ", " + ROW


def _solve(alone: bool, above: bool, most_rows: int, most_turns: int):
    """Sorted rows -> settled nodes, then open rows. ``alone``: all rows are one block;
    ``above``: rows are paths of a level below, whose nodes wait for their ids."""
    node, row = _arrow(NODE), _arrow(ROW)
    schema = pa.schema([*node, *row])

    def blocks(batches):
        held, rows, turns = [], 0, 0
        for b in batches:
            size, lo = b.column("key").value_lengths().to_numpy(zero_copy_only=False), 0
            for i in range(b.num_rows if not alone else 0):
                rows, turns = rows + 1, turns + int(size[i])
                if rows >= most_rows or (rows >= 4 and turns >= most_turns):
                    yield [*held, b.slice(lo, i + 1 - lo)]
                    held, rows, turns, lo = [], 0, 0, i + 1
            if lo < b.num_rows:
                held.append(b.slice(lo))
        if held:
            yield held

    def run(batches):
        for part in blocks(batches):
            block = Block(pa.Table.from_batches(part))
            if alone:
                opened, rows, names = np.zeros(len(block.row), dtype=bool), [], {}
            else:
                opened, rows, names = block.open_rows()
            keep = np.flatnonzero(~opened)
            own = {}
            if above:
                for r in range(block.m):
                    own |= dict(zip(block.path(r).tolist(), block.prefix_digests(r)))
            cols = [pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(block.finals(keep, names, own), node)]
            for lo in range(0, len(keep), 50_000):
                n = min(50_000, len(keep) - lo)
                yield pa.RecordBatch.from_arrays([c.slice(lo, n) for c in cols] + [pa.nulls(n, f.type) for f in row], schema=schema)
            if rows:
                more = [pa.array(c, f.type) for c, f in zip(zip(*rows), row)]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(rows), f.type) for f in node] + more, schema=schema)
    return run


def trie(seqs: DataFrame, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Nodes of the prefix trie of (conv_id, seq): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    nodes, below = [c.split()[0] for c in NODE.split(", ")], [c.split()[0] for c in ROW.split(", ")]
    rows, levels = spool(distinct_sequences(seqs)), []
    while True:
        n, turns = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("key")), F.lit(0))).first()
        alone = n <= 4 or (n <= block_rows and turns <= 4 * block_turns)
        if alone:
            placed = rows.repartition(1)
        else:
            parts = max(1, math.ceil(n / block_rows), math.ceil(turns / block_turns))
            placed = rows.repartitionByRange(parts, "key")
        done = placed.sortWithinPartitions("key").mapInArrow(_solve(alone, bool(levels), block_rows, block_turns), LEVEL)
        done = spool(done)
        levels.append(done.where("conv_id IS NOT NULL").select(*nodes))
        if alone:
            break
        rows = done.where("key IS NOT NULL").select(*below)
    if len(levels) == 1:
        return levels[0].drop("own", "parent")
    settled = levels[0]
    for x in levels[1:]:
        settled = settled.unionByName(x)
    names = settled.where("own IS NOT NULL").select(F.col("own").alias("parent"), F.col("conv_id").alias("found"))
    return settled.drop("own").join(names, "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "found")).drop("parent", "found")
