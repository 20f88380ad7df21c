"""WARC fixity audit with Merkle trees over records and ordered offset ranges.

Method: every record's bytes are hashed. Records of a file are grouped by ranges of
``LEAF`` bytes of their offset; a range's hash covers its records in offset order. Ranges
join ``FAN`` by ``FAN`` into wider ones up to a file's root, and files (by number) into
the archive's root. Two replicas are compared from the root: only children of differing
nodes are read on, level by level, down to the records. Records of differing ranges are
aligned by id and digest, so a replica in which a lost record let all later ones move up
differs in that record alone.

A leaf holds at most LEAF / (smallest record) records and an inner node FAN children, so
no group grows with the archive. Nodes are written once per replica (shared folder).

Defined cases: records at equal offsets are ordered by id and digest; a record in one
replica only is 'missing' or 'extra'; records of one id (or without id) that differ are
paired in the order of their offsets; a record that only moved is no damage; equal
replicas give no row; empty replicas too. Ids may be negative or null (file -1); all
files meet in one root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayguard.llm.common import spool

LEAF, FAN = 65_536, 16


def warc_record(uri: Column, record_id: Column, payload: Column) -> Column:
    """The bytes of a response record; null parts are empty."""
    body = F.encode(F.coalesce(payload, F.lit("")), "UTF-8")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(uri, F.lit("")),
                    F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")),
                    F.lit(">\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def index(records: DataFrame, per_file: int) -> DataFrame:
    """(file_id, offset, length, record_id, digest) of records (record_id, bytes) laid one after
    the other in files of ``per_file`` ids; a null id goes to file -1."""
    rows = records.select("record_id", F.octet_length("bytes").cast("long").alias("length"), F.sha2("bytes", 256).alias("digest"),
                          F.coalesce(F.floor(F.col("record_id") / F.lit(per_file)), F.lit(-1)).cast("long").alias("file_id"))
    w = Window.partitionBy("file_id").orderBy("record_id", "digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("offset", F.sum("length").over(w) - F.col("length"))


def _above(child: Column, last: bool) -> Column:
    """Number of the node that takes in ``child``; the last step takes in all that is left."""
    return F.lit(0).cast("long") if last else F.floor(child / FAN).cast("long")


def tree(idx: DataFrame, levels: tuple[int, int]) -> DataFrame:
    """Nodes (level, file_id, part, digest). Level 0 are offset ranges, then wider ranges to the
    file (``levels[0]`` steps), then files by FAN to the root (``levels[1]`` steps)."""
    item = F.struct("offset", F.coalesce("record_id", F.lit(-1)).alias("record_id"), "digest", "length")
    nodes = idx.groupBy("file_id", F.floor(F.col("offset") / LEAF).cast("long").alias("part")).agg(
        F.sha2(F.concat_ws("|", F.transform(F.array_sort(F.collect_list(item)), lambda x: F.concat_ws(
            ":", x["offset"], x["length"], x["digest"]))), 256).alias("digest"))
    out = [spool(nodes)]
    for step in range(sum(levels)):
        in_file = step < levels[0]
        child = F.col("part") if in_file else F.col("file_id")
        up = _above(child, step == sum(levels) - 1)
        keys = [F.col("file_id"), up.alias("part")] if in_file else [up.alias("file_id"), F.lit(0).cast("long").alias("part")]
        out.append(spool(out[-1].groupBy(*keys).agg(F.sha2(F.concat_ws("|", F.transform(
            F.array_sort(F.collect_list(F.struct(child.alias("at"), "digest"))),
            lambda x: F.concat_ws(":", x["at"], x["digest"]))), 256).alias("digest"))))
    return reduce(DataFrame.unionByName, (n.select(F.lit(i).alias("level"), "file_id", "part", "digest") for i, n in enumerate(out)))


def depth(idx: DataFrame) -> tuple[int, int]:
    """Steps from ranges to files and from files to the root."""
    m = idx.agg(F.max("offset").alias("o"), F.max(F.abs("file_id")).alias("f")).first()
    steps = lambda n: next(k for k in range(64) if n < FAN ** k)
    return steps((m["o"] or 0) // LEAF), steps(m["f"] or 0) + 1


def _aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differing records of two sets of records."""
    def numbered(df, *by):
        w = Window.partitionBy(*by).orderBy("offset", "length", "digest")
        return df.withColumn("number", F.row_number().over(w))

    def joined(by):
        l, r = (numbered(x, *by).alias(n) for x, n in ((a, "l"), (b, "r")))
        on = reduce(lambda x, y: x & y, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (*by, "number")])
        return l.join(r, on, "full")

    alike = joined(("file_id", "record_id", "digest"))
    cols = ["file_id", "offset", "length", "record_id", "digest"]
    only = lambda one, other: alike.where(F.col(f"{other}.offset").isNull()).select(*[F.col(f"{one}.{c}") for c in cols])
    a, b = spool(only("l", "r")), spool(only("r", "l"))
    pairs = joined(("file_id", "record_id"))
    status = F.when(F.col("r.offset").isNull(), "missing").when(F.col("l.offset").isNull(), "extra").otherwise("changed")
    first = lambda c: F.when(F.col("l.offset").isNull(), F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c)
    return pairs.select(*[first(c) for c in cols[:4]], status.alias("status"))


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differing records of two replica indexes: (file_id, offset, length, record_id, status)."""
    a, b = spool(a), spool(b)
    deep = tuple(map(max, zip(depth(a), depth(b))))
    ta, tb = tree(a, deep), tree(b, deep)
    bad: DataFrame | None = None
    for level in range(sum(deep), -1, -1):
        sides = []
        for t, name in ((ta, "da"), (tb, "db")):
            n = t.where(F.col("level") == level).select("file_id", "part", F.col("digest").alias(name))
            if bad is not None:  # only children of differing nodes
                in_file = level < deep[0]
                up = _above(F.col("part") if in_file else F.col("file_id"), level == sum(deep) - 1)
                n = n.withColumn("pf", F.col("file_id") if in_file else up).withColumn("pp", up if in_file else F.lit(0).cast("long"))
                n = n.join(bad, ["pf", "pp"], "left_semi").drop("pf", "pp")
            sides.append(n)
        both = sides[0].join(sides[1], ["file_id", "part"], "full")
        bad = spool(both.where(~F.col("da").eqNullSafe(F.col("db"))).select(F.col("file_id").alias("pf"), F.col("part").alias("pp")))
    sides = [t.withColumn("pf", F.col("file_id")).withColumn("pp", F.floor(F.col("offset") / LEAF).cast("long"))
             .join(bad, ["pf", "pp"], "left_semi").drop("pf", "pp") for t in (a, b)]
    return _aligned(*sides)
