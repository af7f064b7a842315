"""Row cleaning of sales lines and events.

Each step is a plain filter or projection, so Spark fuses the chain into the
scan stage; nothing is counted in between.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.dates import is_weekend, iso_day_of_week, parse_date, parse_event_time
from tillmark.functions.numbers import money
from tillmark.functions.ordering import first_per_key
from tillmark.schemas import EVENT_COLUMNS, EVENT_TYPES


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with all the columns present; plain null tests, which reach the scan."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def with_parsed_date(df: DataFrame, day: str = "transaction_date") -> DataFrame:
    """The day column as a date; text that is none becomes null."""
    return df.withColumn(day, parse_date(day)) if dict(df.dtypes)[day] == "string" else df


def valid_pos_rows(df: DataFrame) -> DataFrame:
    """Sales lines with keys, a readable date, and positive quantity and price; gaps filled."""
    kept = with_parsed_date(require(df, ["transaction_id", "product_id", "store_id"]))
    if "product_name" not in kept.columns:
        kept = kept.withColumn("product_name", F.lit(None).cast("string"))
    return (
        kept.filter("transaction_date is not null and quantity > 0 and unit_price > 0")
        .withColumns({
            "discount": F.coalesce("discount", F.lit(0)),
            "product_name": F.coalesce("product_name", F.col("product_id").cast("string")),
        })
    )


def with_measures(df: DataFrame) -> DataFrame:
    """Gross, discount and net, each rounded to cents, so that gross - discount = net exactly."""
    return (
        df.withColumns({
            "unit_price": money("unit_price"),
            "discount": F.coalesce(F.col("discount").cast("decimal(5,4)"), F.lit(0).cast("decimal(5,4)")),
        })
        .withColumn("gross_revenue", F.round(F.col("quantity") * F.col("unit_price"), 2).cast("decimal(12,2)"))
        .withColumn("discount_amount", F.round(F.col("gross_revenue") * F.col("discount"), 2).cast("decimal(12,2)"))
        .withColumn("net_revenue", (F.col("gross_revenue") - F.col("discount_amount")).cast("decimal(12,2)"))
    )


def clean_pos(df: DataFrame, key: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """Valid sales lines, the first per key by date, with recomputed revenue."""
    return with_measures(first_per_key(valid_pos_rows(df), list(key), ["transaction_date"]))


def sales_projection(df: DataFrame, *extra: str) -> DataFrame:
    """Cleaned sales lines in the shape of the sales fact."""
    return df.select(
        "transaction_id", "transaction_date", "store_id", "product_id", "customer_id", "payment_method",
        F.lit("store").alias("channel"), F.col("quantity").alias("quantity_sold"), "unit_price",
        "discount_amount", "gross_revenue", "net_revenue", F.lit("pos").alias("source_system"), *extra,
    )


def with_time_features(df: DataFrame, day: str = "transaction_date", dow_base: int = 1) -> DataFrame:
    """Calendar columns of the day; ``dow_base`` is the number of Monday."""
    return df.withColumns({
        "day_of_week": iso_day_of_week(day) + (dow_base - 1),
        "week_of_year": F.weekofyear(day),
        "month_num": F.month(day),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": is_weekend(day),
    })


def clean_events(df: DataFrame, event_types: Sequence[str] = tuple(EVENT_TYPES)) -> DataFrame:
    """Known events with their keys and no bad price, first per event id, time parsed."""
    kept = require(df, ["event_id", "event_type", "product_id"]).filter(
        F.col("event_type").isin(list(event_types)) & (F.col("price").isNull() | (F.col("price") >= 0)))
    first = first_per_key(kept, ["event_id"], ["event_timestamp"])
    if dict(first.dtypes)["event_timestamp"] == "string":
        first = first.withColumn("event_timestamp", parse_event_time("event_timestamp"))
    return first


def event_projection(df: DataFrame, *extra: str) -> DataFrame:
    """The flat event's columns, and the named ones."""
    return df.select(*EVENT_COLUMNS, *extra)
