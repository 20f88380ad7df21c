"""Feature table kept up to date batch by batch, without rereading the history.

The store holds, besides the feature table by month, what the tallies need to go on:

* ``seen``: (customer, tag, value) with its first day, cut by customer bucket. A batch adds
  a part per bucket with the values that are new or were seen earlier than known; the first
  day of a value is the least of all parts. More than ``LAYERS`` parts of a bucket become one;
* ``first``: how many values of a tag were first seen on each (customer, day), in the same
  cut; a value that moves to an earlier day counts once more there and once less on the old
  day, so these add up over the parts;
* ``daily``: the per-day values with their sums. A batch adds one folder, which the manifest
  lists under each day that it has rows of; the sums of a value add up over the folders of its
  day. The folders of a day become one where they are more than ``LAYERS``.

``seen`` and ``daily`` are the rows of ``tally.first_rows``, which merge associatively (first
day = minimum, sums add). A row that comes late, for a day long past, only moves a first day
or adds to a day's values: any order of batches ends in the same state. Feature rows can
change only for the batch's customers from their earliest day in it on; these rows alone are
computed again, from the counts of first days and the daily values, and replace the old ones
in their months. One manifest commits all of it.

Plan of ``append``: the batch's rows and the known values of its buckets are dealt by customer
and meet in the aggregation that tallies the batch; what it gives is written once, and new
first days and per-day values are part of the store as written. Then one window over the
counts of the touched customers, with all days before their earliest in the batch as one.
Nothing reads order lines, hits or sessions of earlier batches.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayguard.operators import families
from dayguard.operators.tally import (DAY, KEY, Slots, Tally, by_customer, count_columns, day_counts, first_rows, merge_rows,
                                      tallies_of)
from dayguard.params import Params
from dayguard.schema import FEATURES, KEY_COLS
from dayguard.session import ensure_checkpoint_dir, stored
from dayguard.sources.parts import Store, content_digest
from dayguard.sources.tables import Inputs

BUCKETS = 64  # of customers; choose it so that a bucket's values fit some tasks
LAYERS = 12   # parts of a bucket, or folders of a day, that are read together
DAILY, KNOWN = "daily", "known"


def _month(day) -> F.Column:
    return F.date_format(day, "yyyy-MM")


def _day(day) -> F.Column:
    return F.date_format(day, "yyyy-MM-dd")


def _is_seen(t: Tally) -> bool:
    return not t.per_day


def _seen_schema(rows: T.StructType) -> T.StructType:
    return T.StructType([rows[KEY], rows["e"], rows[DAY]])


def _first_schema(rows: T.StructType, tallies: list[Tally]) -> T.StructType:
    names = [c for t in tallies if _is_seen(t) for c in count_columns(t)[0]]
    return T.StructType([rows[KEY], rows[DAY], *[T.StructField(c, T.LongType()) for c in names]])


@dataclass
class FeatureState:
    """A feature table and its tallies in a folder that all executors share."""

    store: Store
    params: Params
    buckets: int = BUCKETS

    @staticmethod
    def open(spark, path: str, params: Params, buckets: int = BUCKETS) -> "FeatureState":
        """``buckets`` belongs to the store: always open it with the same number."""
        store = Store.open(spark, path)
        if any(kind in ("seen", "daily") and not re.search(r"-\d{6}$", part) for kind, part in store.parts):
            raise ValueError(f"{path} holds whole buckets and days, as earlier versions cut them: take the batches in anew")
        return FeatureState(store, params, buckets)

    def bucket(self) -> F.Column:
        """By the hash that deals rows by customer: a task's customers are of one bucket where
        the number of tasks is a multiple of the buckets."""
        return F.format_string("%05d", F.pmod(F.hash(KEY), F.lit(self.buckets)))

    def _parts(self, kind: str, buckets: list[str]) -> list[str]:
        return [p for k, p in self.store.parts if k == kind and p.split("-")[0] in buckets]

    def append(self, batch: str, inp: Inputs) -> "FeatureState":
        """Take in a batch: rows of any days, of all inputs, none of them taken in before.
        A batch that is in already changes nothing."""
        spark, store = self.store.spark, self.store
        fams = families.all_families(inp, self.params)
        sources = families.family_sources(inp, self.params, fams)
        window = (self.params.feature_start, self.params.feature_end)
        tallies = tallies_of(sources)
        assert not any(_is_seen(t) and (t.sums or t.doubles or t.counts) for t in tallies), "first days carry no sums"
        schema = first_rows(sources, window).schema
        again, known = batch in store.batches, []
        if not again and any(k == "seen" for k, _ in store.parts):
            keys = reduce(DataFrame.union, [df.select(self.bucket().alias("b")) for df, _ in sources])
            known = self._parts("seen", [r[0] for r in keys.distinct().collect()])  # at most buckets
        rows = first_rows(sources, window, store.read("seen", _seen_schema(schema), known) if known else None)
        if not known:
            rows = rows.withColumn("old", F.lit(None).cast("date"))
        place = Store(spark, ensure_checkpoint_dir(spark).rstrip("/")) if again else store
        part = F.when(F.col("e.d").isNotNull(), DAILY).when(F.col(DAY) >= F.col("old"), KNOWN).otherwise(self.bucket())
        laid = place.lay("rows", rows.withColumn("part", part))
        rows = spark.read.schema(rows.schema).parquet(*laid.values()) if laid else spark.createDataFrame([], rows.schema)
        tallied = rows.select(*schema.names)
        digest = content_digest(rows.select(*schema.names))
        if store.known(batch, digest):
            place.discard(list(laid.values()))
            return self
        version = f"{store.version + 1:06d}"
        changed: dict = {("seen", f"{b}-{version}"): f for b, f in laid.items() if b not in (DAILY, KNOWN)}
        if changed:
            new = spark.read.schema(rows.schema).parquet(*changed.values())
            changed |= self._first(new, tallies, version)
        if DAILY in laid:
            changed |= self._daily_parts(laid[DAILY], schema, version)
        changed |= self._merged_layers(store.with_parts(changed), schema, tallies, version)
        since = rows.groupBy(KEY).agg(F.min(DAY).alias("since"))
        after = FeatureState(store.with_parts(changed), self.params, self.buckets)
        changed |= self._replaced(after._features(schema, tallies, fams, since, laid.get(DAILY)))
        out = FeatureState(store.commit(changed, batch, digest), self.params, self.buckets)
        out.store.discard([laid[KNOWN]] if KNOWN in laid else [])
        return out

    def _first(self, new: DataFrame, tallies: list[Tally], version: str) -> dict:
        """Counts of first days that the values of ``new`` add, or move from their old days."""
        plus = day_counts(new, tallies, _is_seen)
        moved = new.where("old IS NOT NULL").select(KEY, F.col("old").alias(DAY), "e")
        names = [c for c in plus.columns if c not in (KEY, DAY)]
        minus = day_counts(moved, tallies, _is_seen).select(KEY, DAY, *[(-F.col(c)).alias(c) for c in names])
        return self.store.write("first", plus.unionByName(minus).withColumn("part", F.concat(self.bucket(), F.lit(f"-{version}"))))

    def _daily_parts(self, folder: str, schema: T.StructType, version: str) -> dict:
        """The folder under each of its days."""
        days = self.store.spark.read.schema(schema).parquet(folder).select(_day("e.d").alias("d")).distinct().collect()
        return {("daily", f"{r[0]}-{version}"): folder for r in days}  # at most the windows' days

    def _merged_layers(self, store: Store, rows_schema: T.StructType, tallies: list[Tally], version: str) -> dict:
        """One part in place of those of each bucket that has more than ``LAYERS``, and one
        folder in place of those of the days that have more."""
        changed: dict = {}
        for kind, schema in (("seen", _seen_schema(rows_schema)), ("first", _first_schema(rows_schema, tallies)), ("daily", rows_schema)):
            layers: dict = {}
            for k, p in store.parts:
                if k == kind:
                    layers.setdefault(p.rsplit("-", 1)[0], []).append(p)
            old = {p for ps in layers.values() if len(ps) > LAYERS for p in ps}
            if not old:
                continue
            folders = sorted({store.parts[kind, p] for p in old})
            old = {p for (k, p), f in store.parts.items() if k == kind and f in folders}  # a folder's other days go along
            rows = store.spark.read.schema(schema).parquet(*folders)
            changed |= {(kind, p): None for p in old}
            if kind == "daily":
                one = merge_rows(rows, Slots.of(tallies)).withColumn("part", F.lit(DAILY))
                changed |= self._daily_parts(store.lay(kind, by_customer(one))[DAILY], schema, version)
                continue
            if kind == "seen":
                one = rows.groupBy(KEY, "e").agg(F.min(DAY).alias(DAY))
            else:
                one = rows.groupBy(KEY, DAY).agg(*[F.sum(c).alias(c) for c in schema.names[2:]])
            changed |= store.write(kind, one.withColumn("part", F.concat(self.bucket(), F.lit(f"-{version}"))))
        return changed

    def _daily_rows(self, schema: T.StructType, tallies: list[Tally], since: DataFrame, from_day: str | None, own: str | None) -> DataFrame:
        """One row per per-day value of the customers in ``since`` from their day on. The rows
        of the folder ``own``, the batch's, are all such rows."""
        held: dict = {}  # day -> folders
        for (k, p), f in self.store.parts.items():
            if k == "daily" and from_day is not None and p[:len(from_day)] >= from_day:
                held.setdefault(p[:len(from_day)], []).append(f)
        folders = {f for fs in held.values() for f in fs}
        read = lambda fs: self.store.spark.read.schema(schema).parquet(*sorted(fs))
        found = [read({own})] if own in folders else []
        if folders - {own}:
            found.append(read(folders - {own}).join(since, KEY).where(F.col("e.d") >= F.col("since")).select(*schema.names))
        if not found:
            return self.store.spark.createDataFrame([], schema)
        rows = reduce(DataFrame.unionByName, found)
        twice = [F.lit(d).cast("date") for d, fs in held.items() if len(fs) > 1]
        if not twice:
            return rows
        shared = F.col("e.d").isin(*twice)
        return rows.where(~shared).unionByName(merge_rows(rows.where(shared), Slots.of(tallies)).select(*schema.names))

    def _features(self, schema, tallies, fams, since: DataFrame, own: str | None) -> DataFrame:
        """Feature rows of the customers in ``since`` from their day ``since`` on, out of the state."""
        since = stored(since)
        from_day = since.agg(F.min(_day("since"))).first()[0]
        mine = [r[0] for r in since.select(self.bucket()).distinct().collect()]
        # earlier days' own values change no row from ``since`` on, so these alone have session days
        daily = day_counts(self._daily_rows(schema, tallies, since, from_day, own), tallies, lambda t: t.per_day)
        first = self.store.read("first", _first_schema(schema, tallies), self._parts("first", mine)).join(since, KEY)
        before = (first.withColumn(DAY, F.greatest(DAY, F.date_sub("since", 1))).groupBy(KEY, DAY)
                  .agg(*[F.sum(c).alias(c) for c in _first_schema(schema, tallies).names[2:]]))
        cols = []
        for t in tallies:
            counts, sums = count_columns(t)
            cols += [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counts] + [F.sum(c).alias(c) for c in sums]
        both = before.unionByName(daily, allowMissingColumns=True).repartition(KEY).groupBy(KEY, DAY).agg(*cols)
        return families.outputs_of(both, fams).select(*KEY_COLS, *FEATURES)

    def _replaced(self, again: DataFrame) -> dict:
        """Months of the feature table with the rows of ``again`` in place of the old ones."""
        new = stored(again).withColumn("part", _month(KEY_COLS[1]))
        touched = [r[0] for r in new.select("part").distinct().collect()]
        old = self.store.read("features", again.schema, touched)
        kept = old.join(new.select(*KEY_COLS), KEY_COLS, "left_anti").withColumn("part", _month(KEY_COLS[1]))
        return self.store.write("features", kept.select(*new.columns).unionByName(new))

    def features(self, months: list[str] | None = None) -> DataFrame:
        """The feature table as of the last committed batch (of some months only, if given)."""
        from dayguard.sources.csvio import FEATURE_SCHEMA
        return self.store.read("features", FEATURE_SCHEMA, months)
