r"""Prefix-target chat examples: every assistant turn is an example of its own.

An example's text is all turns before an assistant turn and that turn; only the reply is
trainable. Written out, the examples of a conversation of T turns hold its text some T / 2
times, so the context is shared: ``pieces`` holds every formatted turn once with its place
in the conversation, and an example is a prefix [0, end) of that text with its loss mask
[loss_start, loss_end). ``render`` writes chosen examples out.

Template: ``### role: text</turn>`` and a line feed. Backslash, ``#`` and ``<`` of a text
(and ``:`` of a role) get a backslash before them, so neither ``###`` nor ``</turn>`` can
come from a text, and dropping the backslashes gives the text back.

Plan: one window over (conversation, turn) for positions and offsets; examples are a filter
of its rows. Reading back streams a conversation's pieces in order through two hashes, so
a conversation of any length needs one piece's memory.

Defined cases: null text or role is empty; null turns come first; equal turns are ordered
by role and text; a null conv_id is a conversation of its own; repeated rows are turns like
others; turns after the last reply are pieces and in no example; a conversation without a
reply has no example and an empty loss; an empty table gives empty tables; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET = "assistant"
HEAD, MIDDLE, TAIL = "### ", ": ", "</turn>\n"
PIECE = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def escaped(text: Column, more: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#<{more}])", r"\\$1")


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def pieces(turns: DataFrame) -> DataFrame:
    """conv_id, position (from 0), piece, start, end (code points in the conversation's
    formatted text), loss_start, loss_end (null unless the turn is a reply)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    body, who = escaped(F.col("text")), escaped(F.col("role"), ":")
    t = t.withColumn("before", F.concat(F.lit(HEAD), who, F.lit(MIDDLE))).withColumn("body", body)
    t = t.withColumn("piece", F.concat("before", "body", F.lit(TAIL)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.select("conv_id", "role", "piece", F.length("before").cast("long").alias("b"), F.length("body").cast("long").alias("n"),
                 (F.row_number().over(order) - 1).cast("long").alias("position"),
                 F.sum(F.length("piece").cast("long")).over(upto).alias("end"))
    t = t.withColumn("start", F.col("end") - F.length("piece"))
    begin = F.when(F.col("role") == TARGET, F.col("start") + F.col("b"))
    return t.select("conv_id", "position", "piece", "start", "end", begin.alias("loss_start"), (begin + F.col("n")).alias("loss_end"))


def examples(placed: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, target (its position), end (code points of the
    example, its reply included), loss_start, loss_end."""
    return placed.where("loss_start IS NOT NULL").select(
        "conv_id", F.col("position").alias("target"), "end", "loss_start", "loss_end")


def render(chosen: DataFrame, placed: DataFrame) -> DataFrame:
    """Chosen examples with their whole ``text``: the pieces up to each target, joined."""
    e, p = chosen.alias("e"), placed.select("conv_id", "position", "piece").alias("p")
    both = e.join(p, F.col("e.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("p.position") <= F.col("e.target")))
    parts = F.array_sort(F.collect_list(F.struct("p.position", "p.piece")))
    return both.groupBy(*[F.col(f"e.{c}") for c in chosen.columns]).agg(parts.alias("parts")).select(
        *chosen.columns, F.array_join(F.transform("parts", lambda x: x["piece"]), "").alias("text"))


def parse(piece: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    m = PIECE.fullmatch(piece)
    return unescaped(m[1]), unescaped(m[2])


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long, example_chars long"


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.examples = self.example_chars = 0

    def add(self, piece, start, end, lo, hi):
        role, text = parse(piece)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.n += 1
        self.chars += len(piece)
        if lo is not None:
            reply = unescaped(piece[lo - start:hi - start])
            self.loss.update(reply.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(reply)
            self.examples += 1
            self.example_chars += end

    def row(self):
        return (self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.examples, self.example_chars)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in READ.split(", ")])
    now, done = None, []
    for b in batches:
        for conv_id, *x in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)]):
            if now is None or conv_id != now.conv_id:
                done += [now.row()] if now else []
                now = _Conversation(conv_id)
            now.add(*x)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done = []
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(now.row(), schema)], schema=schema)


def read_back(placed: DataFrame, chosen: DataFrame) -> DataFrame:
    """What the written output says of every conversation: turns parsed from the pieces,
    replies cut out by the examples' loss masks."""
    mask = chosen.select(F.col("conv_id").alias("c"), F.col("target").alias("t"), F.col("loss_start").alias("lo"), F.col("loss_end").alias("hi"))
    p = placed.join(mask, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("position") == F.col("t")), "left")
    return (p.repartition("conv_id").sortWithinPartitions("conv_id", "position")
            .select("conv_id", "piece", "start", "end", "lo", "hi").mapInArrow(_read, READ))
