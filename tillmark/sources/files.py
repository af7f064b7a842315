"""Raw batch files and lake tables.

A day is a predicate on the partition columns of one table root, never a
hand-built path list, so Spark prunes directories and a range of days is one scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillmark.functions.dates import parse_date
from tillmark.schemas import RAW_EVENT, RAW_POS


def partition_path(lake: str, layer: str, source: str, day: str) -> str:
    """Where one day of a source lives: ``<lake>/<layer>/<source>/year=/month=/day=``."""
    year, month, dom = day.split("-")
    return f"{lake}/{layer}/{source}/year={year}/month={month}/day={dom}"


def with_day_columns(df: DataFrame, day: str) -> DataFrame:
    """Partition columns taken from a date column."""
    return df.withColumns({
        "year": F.year(day),
        "month": F.lpad(F.month(day).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
    })


def days_between(first: str, last: str) -> Column:
    """Partition predicate for first..last inclusive; compares partition columns only."""
    start, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    packed = F.col("year") * 10000 + F.col("month").cast("int") * 100 + F.col("day").cast("int")
    return packed.between(_packed(start), _packed(end))


def _packed(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _with_partitions(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add("year", "integer").add("month", "string").add("day", "string")


def raw_pos(spark: SparkSession, lake: str, first: str, last: str | None = None) -> DataFrame:
    """Raw sales lines of a day (or an inclusive range): empty text is null, NaN is read as such.

    ``source_day`` is the day the rows were delivered for.  A file whose header does not name
    the columns in their order is refused, since columns are read by their place.
    """
    return (
        spark.read.schema(_with_partitions(RAW_POS))
        .option("header", True).option("enforceSchema", False).option("nullValue", "").option("nanValue", "NaN")
        .csv(f"{lake}/raw/pos")
        .filter(days_between(first, last or first))
        .withColumn("source_day", F.make_date("year", F.col("month").cast("int"), F.col("day").cast("int")))
        .drop("year", "month", "day")
    )


def raw_events(spark: SparkSession, lake: str, first: str, last: str | None = None, with_day: bool = False) -> DataFrame:
    """Raw events of a day (or range), one JSON object per line; ``with_day`` adds the ``source_day`` they came in.

    Below the day lie the ingest hour and the micro-batch.
    """
    schema = _with_partitions(RAW_EVENT).add("hour", "string").add("batch", "string")
    events = spark.read.schema(schema).json(f"{lake}/raw/ecommerce").filter(days_between(first, last or first))
    if with_day:
        events = events.withColumn("source_day", F.make_date("year", F.col("month").cast("int"), F.col("day").cast("int")))
    return events.drop("year", "month", "day", "hour", "batch")


def event_array_file(spark: SparkSession, path: str) -> DataFrame:
    """A sample file holding one JSON array of events.

    Spark cannot split such a file, so it is meant for samples; daily volumes
    belong in line-delimited files (`raw_events`).
    """
    return spark.read.schema(RAW_EVENT).option("multiLine", True).json(path)


def processed_sales(spark: SparkSession, lake: str, as_of: str, lookback_days: int) -> DataFrame:
    """The `lookback_days` days of processed sales before `as_of`; missing days are simply absent."""
    day = dt.date.fromisoformat(as_of)
    first = (day - dt.timedelta(days=lookback_days)).isoformat()
    last = (day - dt.timedelta(days=1)).isoformat()
    return spark.read.parquet(f"{lake}/processed/pos_fact").filter(days_between(first, last))


def weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather by date and state; unreadable values become null."""
    raw = spark.read.schema(
        "date string, state string, temp_high_f string, temp_low_f string, "
        "precipitation_in string, snow_in string, condition string").option("header", True).csv(path)
    return raw.select(
        parse_date("date").alias("weather_date"),
        F.col("state").alias("weather_state"),
        F.expr("try_cast(temp_high_f as double)").alias("temp_high_f"),
        F.expr("try_cast(precipitation_in as double)").alias("precipitation_in"),
        F.col("condition").alias("weather_condition"),
    )


def holidays(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("date string, holiday_name string, is_federal string").option("header", True).csv(path)
    return raw.select(
        parse_date("date").alias("holiday_date"), "holiday_name", F.lit(True).alias("is_holiday"))


def inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ad-hoc CSV of unknown schema; reads the file twice, so not for daily loads."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def land_sales(df: DataFrame, lake: str, day: str) -> str:
    """Place a day's sales lines in the raw layer, replacing what that day held."""
    target = partition_path(lake, "raw", "pos", day)
    ordered = df.select(RAW_POS.fieldNames())
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True).csv(target)
    return target


def land_events(df: DataFrame, lake: str, day: str) -> str:
    """Place a day's events in the raw layer, next to what the stream wrote that day."""
    target = partition_path(lake, "raw", "ecommerce", day) + "/hour=00/batch=landed"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").json(target)
    return target
