"""JDBC appends, for where a database driver is on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 5000, connections: int = 4,
                mode: str = "append", **options: str) -> None:
    """Batched inserts over a bounded number of connections."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table)
     .option("batchsize", batch_size).option("numPartitions", connections)
     .option("isolationLevel", "READ_COMMITTED").options(**options).mode(mode).save())
