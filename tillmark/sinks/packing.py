"""Packing the raw lake: many small files of closed hours into few."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillmark.sinks.keyindex import _delete, _names, _read_text, _write_text, one_writer
from tillmark.sinks.lake import _hadoop_path

#: The folder that takes the place of an hour's batches, and the file in the hour that names these.
PACKED = "batch=packed"
NOTE = "_packed"
LEVELS = ["year", "month", "day", "hour"]


def packed_batches(spark: SparkSession, hour_path: str) -> set[str]:
    """The batches an hour's packed files hold."""
    return set(filter(None, (_read_text(spark, f"{hour_path}/{NOTE}") or "").split("\n")))


def _closed_hours(spark: SparkSession, root: str, before: dt.datetime) -> dict[str, list[str]]:
    """Hour folders that ended before the time and have several batch folders, with those."""
    location, fs = _hadoop_path(spark, root)
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location, "/".join(f"{level}=*" for level in LEVELS))
    found = {}
    for status in fs.globStatus(pattern) or []:
        parts = status.getPath().toString().split("/")[-4:]
        year, month, day, hour = (int(p.partition("=")[2]) for p in parts)
        if dt.datetime(year, month, day, hour) + dt.timedelta(hours=1) <= before:
            path = f"{root}/{'/'.join(parts)}"
            batches = [n for n in _names(spark, path) if n.startswith("batch=")]
            if len(batches) > 1:
                found[path] = batches
    return found


def pack_hours(spark: SparkSession, lake: str, before: dt.datetime) -> int:
    """Bring the batches of each hour that ended before ``before`` (in the session's time zone) together; the number of hours.

    One job writes all hours aside, in files of about spark.sql.adaptive.advisoryPartitionSizeInBytes; then each
    hour's folder is replaced as a whole.  The stream writes to the current hour only.  A batch that it repeats after a
    failure goes to the hour it was first taken in: the hour's note says that it is packed already, and it is left out.
    ``before`` should lie further back than a batch may take.
    """
    root = f"{lake}/raw/ecommerce"
    with one_writer(spark, root, "packing"):
        hours = _closed_hours(spark, root, before)
        if not hours:
            return 0
        tag = uuid.uuid4().hex
        staged, aside = f"{lake}/raw/__packing-{tag}", f"{lake}/raw/__replaced-{tag}"
        schema = "value string, " + ", ".join(f"{level} string" for level in [*LEVELS, "batch"])
        lines = spark.read.schema(schema).option("basePath", root).text(list(hours))
        (lines.withColumn("batch", F.lit(PACKED.partition("=")[2])).hint("rebalance", *LEVELS)
         .write.partitionBy(*LEVELS, "batch").text(staged))
        for path, batches in hours.items():
            part = path[len(root) + 1:]
            names = packed_batches(spark, path) | {b.partition("=")[2] for b in batches if b != PACKED}
            _write_text(spark, f"{staged}/{part}/{NOTE}", "\n".join(sorted(names)))
            old, fs = _hadoop_path(spark, f"{aside}/{part}")
            fs.mkdirs(old.getParent())
            here, new = _hadoop_path(spark, path)[0], _hadoop_path(spark, f"{staged}/{part}")[0]
            if not fs.rename(here, old):
                raise OSError(f"{path} could not be moved aside; its packed rows are in {staged}/{part}")
            if not fs.rename(new, here):
                raise OSError(f"{path} is in {aside}/{part}; its packed rows are in {staged}/{part}")
        _delete(spark, staged)
        _delete(spark, aside)
        return len(hours)
