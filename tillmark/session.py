"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on.  Shuffle width is left to the cluster; AQE coalesces it.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time instead of landing in one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet's statistics and bloom filters get the keys of a small load one by one.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Rewriting a day replaces that day's partitions only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keeps streaming state off the heap and checkpoints its changes only.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Sessions of one user are merged on the map side before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str = "tillmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine and be lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        current = tempfile.mkdtemp(prefix="tillmark-")
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder, unique per call."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, label: str = "stage") -> DataFrame:
    """Compute once into a Parquet table in the shared folder and read it from there.

    Like a checkpoint it cuts the lineage and survives the loss of executors, but
    later reads are columnar and Spark knows the size.  The folder is scratch: what
    expires ``spark.checkpoint.dir`` expires it too.
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
