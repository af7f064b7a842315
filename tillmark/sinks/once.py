"""Changes to a partitioned table that take effect once, even if a batch is repeated or fails half-way."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tillmark.sinks.keyindex import _delete, _names, _read_text, _write_text, one_writer
from tillmark.sinks.lake import path_exists, write_partitions


def change_once(spark: SparkSession, path: str, stream: str, batch_id: int, by: str,
                change: Callable[[], tuple[DataFrame, Sequence[str]]]) -> bool:
    """Replace the partitions that a batch changes; whether it was applied now.

    ``change`` gives the whole new rows of the partitions it touches and the values of the partition column ``by``, as
    text; a touched partition without rows goes.  The rows are staged first, then put in place, then the batch is noted as
    the stream's last one.  A batch repeated after a failure puts the staged rows in place again, and one noted already
    does nothing, so changes need not be idempotent themselves: they may add to what is there.
    """
    with one_writer(spark, path, stream):
        notes, staged = f"{path}__applied", f"{path}__staged/{stream}-{batch_id}"
        last = max((int(n.rpartition("-")[2]) for n in _names(spark, notes) if n.startswith(f"{stream}-")), default=-1)
        if batch_id <= last:
            return False
        touched = _read_text(spark, f"{staged}/touched")
        if touched is None:
            rows, values = change()
            rows.write.mode("overwrite").parquet(f"{staged}/rows")
            touched = "\n".join(sorted(values))
            # Written last, so what is staged is whole.
            _write_text(spark, f"{staged}/touched", touched)
        if touched:
            rows = spark.read.parquet(f"{staged}/rows")
            left = {str(r[0]) for r in rows.select(by).distinct().collect()}
            for value in set(touched.split("\n")) - left:
                _delete(spark, f"{path}/{by}={value}")
            if left:
                write_partitions(rows, path, [by])
        _write_text(spark, f"{notes}/{stream}-{batch_id}", "")
        if last >= 0:
            _delete(spark, f"{notes}/{stream}-{last}")
        _delete(spark, staged)
        return True


def stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table, or an empty one before its first change or after its last row went."""
    there = path_exists(spark, path) and any("=" in n for n in _names(spark, path))
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
