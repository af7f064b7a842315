"""Lake tables and exports.

Partitioned writes replace only the partitions they contain, so re-running a day
or a range of days is idempotent and leaves other days alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.schemas import CHECK_LOG
from tillmark.sources.files import with_day_columns


def _hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whichever store the cluster keeps the table in."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    location, fs = _hadoop_path(spark, path)
    return fs.exists(location)


def replace_table(df: DataFrame, path: str) -> str:
    """Replace a table that ``df`` may itself be read from.

    The new rows are written aside in full before the folders are swapped, so a
    failed job leaves the old table.  Meant for dimensions and other whole-table
    rewrites; partitioned tables use `write_partitions`.
    """
    spark, tag = df.sparkSession, uuid.uuid4().hex
    staged, old = f"{path}__new_{tag}", f"{path}__old_{tag}"
    df.write.parquet(staged)
    location, fs = _hadoop_path(spark, path)
    aside, new = _hadoop_path(spark, old)[0], _hadoop_path(spark, staged)[0]
    had = fs.exists(location)
    if had and not fs.rename(location, aside):
        raise OSError(f"{path} could not be moved aside; its new rows are in {staged}")
    if not fs.rename(new, location):
        if had and not fs.rename(aside, location):
            raise OSError(f"{path} could not be replaced; its old rows are in {old}, its new ones in {staged}")
        raise OSError(f"{path} could not be replaced and is as before; its new rows are in {staged}")
    if had:
        fs.delete(aside, True)
    return path


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> str:
    """Overwrite the touched partitions.

    Rows are brought together by partition value, or each task would open a file
    per partition.  The rebalance hint lets AQE split a value that holds much of
    the data over several tasks and files, and merge small ones.
    """
    laid_out = df.hint("rebalance", *by)
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return path


def write_sales(df: DataFrame, lake: str, day: str = "source_day") -> str:
    """Processed sales, one partition per day of delivery.

    Not by day of sale: a late line in a later delivery would replace its whole day.
    """
    return write_partitions(with_day_columns(df, day), f"{lake}/processed/pos_fact", ["year", "month", "day"])


def write_events(df: DataFrame, lake: str, day: str = "source_day") -> str:
    """Processed events by day of delivery and event type; see `write_sales`."""
    dated = with_day_columns(df, day)
    return write_partitions(dated, f"{lake}/processed/ecommerce_events", ["year", "month", "day", "event_type"])


def write_dataset(df: DataFrame, lake: str, name: str) -> str:
    """Replace a whole named aggregate."""
    path = f"{lake}/processed/{name}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


def export_dataset(df: DataFrame, path: str, run_ts: str, fmt: str = "csv") -> list[str]:
    """An ML export: one folder per run plus a ``latest`` copy.

    The copy is read back from the run's folder, so the features are computed once.
    """
    spark = df.sparkSession
    run, latest = f"{path}/run_ts={run_ts}", f"{path}/latest"

    def write(frame: DataFrame, target: str) -> None:
        writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if fmt == "csv":
            writer.option("header", True).csv(target)
        elif fmt == "parquet":
            writer.option("compression", "snappy").parquet(target)
        else:
            raise ValueError(f"unknown export format {fmt!r}")

    write(df, run)
    reader = spark.read.schema(df.schema)
    write(reader.option("header", True).csv(run) if fmt == "csv" else reader.parquet(run), latest)
    return [run, latest]


def export_by_run_date(df: DataFrame, lake: str, run_date: str) -> str:
    """The daily feature export, one ``dt=`` partition per run date."""
    path = f"{lake}/processed/ml_ready"
    (df.withColumn("dt", F.lit(run_date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", True).partitionBy("dt").csv(path))
    return path


def append_check_log(results: DataFrame, root: str, run_id: str, phase: str) -> str:
    """Add check results to the log, one partition per run and phase, so a retried run does not log twice."""
    path = f"{root}/dq_check_log"
    columns = [F.col(f.name) if f.name in results.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in CHECK_LOG]
    (results.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, CHECK_LOG)])
     .withColumns({"pipeline_run_id": F.lit(run_id), "check_type": F.lit(phase), "run_timestamp": F.current_timestamp()})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("pipeline_run_id", "check_type").parquet(path))
    return path
