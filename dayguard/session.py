"""Session construction and cluster-safe checkpointing."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session in this library relies on.  Shuffle partition count
# is left to the caller on a cluster (AQE coalesces small partitions anyway).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "dayguard") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", os.environ.get("DAYGUARD_DRIVER_MEM", "16g"))
          .config("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024)))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster the directory must be the shared folder named by
    ``spark.checkpoint.dir``; it is read from the session, never invented.
    Only a local-mode session without the setting (tests, bench) gets a fresh
    scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS / object store) so lineage can be cut safely")
    path = tempfile.mkdtemp(prefix="dayguard-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage like
    ``checkpoint`` and keeps column pruning and filter pushdown for what reads it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
