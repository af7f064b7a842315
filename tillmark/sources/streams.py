"""Event streams.  Every source yields one string column ``value`` holding the JSON event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_events(spark: SparkSession, servers: str, topic: str, max_per_batch: int | None = None) -> DataFrame:
    """Events of a topic, from the earliest offset unless the checkpoint knows better.

    Needs the Kafka connector on the classpath.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def json_line_events(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Events from a folder of line-delimited JSON files.

    A micro-batch takes ``max_files`` of them at most, or as many as have ``max_bytes`` together and one at least.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path).select("value")
