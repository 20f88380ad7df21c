"""Versioned Parquet parts behind a manifest: small atomic commits over large tables.

A store holds named tables cut into parts (a month, a hash bucket). A commit writes new
files for the parts that change and then one manifest file that names, for every part, the
folder that holds it; parts that did not change keep their folder. Readers follow the
newest manifest, so a job killed before its manifest leaves files nobody reads, and running
it again gives the same tables. Every commit records the batch it took in and a digest of
the batch's rows: a batch that was committed before is not taken in twice, and another
content under the same name is refused. One writer at a time.

The driver holds the manifest: one short row per part (months and buckets, not data).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "version long, kind string, part string, folder string, note string"
BATCH = "batch"  # kind of the rows that list the batches taken in


def content_digest(df: DataFrame) -> str:
    """Rows and an order-free hash of all values (one row reaches the driver)."""
    cols = [F.to_json(c) if isinstance(t.dataType, (T.MapType, T.VariantType)) else F.col(c) for c, t in ((f.name, f) for f in df.schema)]
    h = F.col("h")
    quarters = [F.sum(F.shiftright(h, at).bitwiseAND(F.lit(0xFFFF if at < 48 else -1).cast("long"))) for at in (0, 16, 32, 48)]
    n, high, *low = df.select(F.xxhash64(*cols).alias("h")).agg(F.count(F.lit(1)), F.bit_xor(h), *quarters).first()
    return f"{n}-{sum((q or 0) << 16 * i for i, q in enumerate(low))}-{high or 0}"  # sums of 16 bits do not overflow


@dataclass
class Store:
    spark: SparkSession
    path: str
    version: int = 0
    parts: dict = field(default_factory=dict)    # (kind, part) -> folder
    batches: dict = field(default_factory=dict)  # batch -> digest

    @staticmethod
    def open(spark: SparkSession, path: str) -> "Store":
        """The newest committed version (an empty store where nothing was committed)."""
        s = Store(spark, path.rstrip("/"))
        try:
            rows = spark.read.schema(MANIFEST).parquet(f"{s.path}/manifest")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return s
        last = rows.agg(F.max("version")).first()[0]
        if last is not None:
            s.version = last
            for r in rows.where(F.col("version") == last).collect():
                if r["kind"] == BATCH:
                    s.batches[r["part"]] = r["note"]
                else:
                    s.parts[(r["kind"], r["part"])] = r["folder"]
        return s

    def known(self, batch: str, digest: str) -> bool:
        """Whether the batch is in already; other rows under its name are an error."""
        if batch not in self.batches:
            return False
        if self.batches[batch] != digest:
            raise ValueError(f"batch {batch!r} was taken in with other rows")
        return True

    def read(self, kind: str, schema: T.StructType, parts: list[str] | None = None) -> DataFrame:
        """The rows of a table, of the named parts only if given."""
        folders = [f for (k, p), f in sorted(self.parts.items()) if k == kind and (parts is None or p in parts)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def write(self, kind: str, df: DataFrame, part: str = "part") -> dict:
        """New files for the parts that ``df`` has rows of: {(kind, part): folder}. Large
        parts are split over tasks and small ones put together by the engine."""
        return {(kind, n): f for n, f in self.lay(kind, df.hint("rebalance", part), part).items()}

    def lay(self, name: str, df: DataFrame, part: str = "part") -> dict:
        """New files for the parts that ``df`` has rows of, as its tasks hold them: {part: folder}."""
        base = f"{self.path}/files/{name}-{uuid.uuid4().hex}"
        df.withColumnRenamed(part, "_part").write.partitionBy("_part").parquet(base)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(base)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)  # parts, not files
        names = [s.getPath().getName() for s in found if s.isDirectory()]
        plain = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {plain(n.removeprefix("_part=")): f"{base}/{n}" for n in names if n.startswith("_part=")}

    def discard(self, folders: list[str]) -> None:
        """Remove folders that no part is made of."""
        used = set(self.parts.values())
        for f in folders:
            if f not in used:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def with_parts(self, changed: dict) -> "Store":
        """The store as a commit of ``changed`` would leave it; a part without a folder is gone."""
        parts = {k: f for k, f in {**self.parts, **changed}.items() if f is not None}
        return Store(self.spark, self.path, self.version, parts, self.batches)

    def commit(self, changed: dict, batch: str, digest: str) -> "Store":
        """One manifest file makes all changed parts visible together."""
        new = Store(self.spark, self.path, self.version + 1, self.with_parts(changed).parts, {**self.batches, batch: digest})
        rows = [(new.version, k, p, f, None) for (k, p), f in sorted(new.parts.items())]
        rows += [(new.version, BATCH, b, None, d) for b, d in sorted(new.batches.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return new
