"""Joins that add context to sales and events.

Lookups carry no broadcast hint unless the calendar bounds them: Spark broadcasts
one when its size is known to be under the configured threshold and otherwise
shuffles, splitting hot keys at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.ordering import attach
from tillmark.sources.warehouse import product_lookup


def with_weather(sales: DataFrame, weather: DataFrame | None, day: str, state: str) -> DataFrame:
    """Weather of the day in the store's state; typed nulls where there is none at all."""
    if weather is None:
        return sales.withColumns({
            "temp_high_f": F.lit(None).cast("double"),
            "precipitation_in": F.lit(None).cast("double"),
            "weather_condition": F.lit(None).cast("string"),
        })
    on = (sales[day] == weather["weather_date"]) & (sales[state] == weather["weather_state"])
    return sales.join(weather, on, "left").drop("weather_date", "weather_state")


def with_holidays(sales: DataFrame, holidays: DataFrame | None, day: str) -> DataFrame:
    """Holiday name and flag of the day; the flag is never null."""
    if holidays is None:
        return sales.withColumns({"holiday_name": F.lit(None).cast("string"), "is_holiday": F.lit(False)})
    named = holidays.select("holiday_date", "holiday_name", F.lit(True).alias("is_holiday"))
    return (
        sales.join(named, sales[day] == named["holiday_date"], "left").drop("holiday_date")
        .withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
    )


def holiday_flag(df: DataFrame, holidays: DataFrame, day: str) -> DataFrame:
    """1 when the day is in the holiday set, else 0."""
    days = holidays.select(F.col("holiday_date").alias("_day")).distinct()
    return (df.join(days, df[day] == days["_day"], "left")
            .withColumn("is_holiday", F.col("_day").isNotNull().cast("int")).drop("_day"))


def with_mean_weather(daily: DataFrame, weather: DataFrame, day: str) -> DataFrame:
    """Mean weather over all states on the day: one row per day, so safe to broadcast."""
    means = weather.groupBy(F.col("weather_date").alias("_day")).agg(
        F.avg("temp_high_f").alias("temp_high_f"), F.avg("precipitation_in").alias("precipitation_in"))
    return daily.join(F.broadcast(means), daily[day] == means["_day"], "left").drop("_day")


def with_product(events: DataFrame, products: DataFrame | None) -> DataFrame:
    """Category and list price of the event's product, where known; typed nulls without a product dimension."""
    if products is None:
        return events.withColumns({"dim_category": F.lit(None).cast("string"), "list_price": F.lit(None).cast("decimal(12,2)")})
    return events.join(product_lookup(products), "product_id", "left")


def with_session_metrics(events: DataFrame) -> DataFrame:
    """Event count and purchase flag of the session, on every event.

    The session is summed first (map-side, so a session with a third of all
    events ships as a few rows) and joined back; AQE splits the hot side of that
    join.  Events without a session form one group, as in a window by session.
    """
    flagged = events.withColumn("is_purchase", (F.col("event_type") == "purchase").cast("int"))
    sessions = flagged.groupBy("session_id").agg(
        F.count("event_id").alias("session_event_count"), F.max("is_purchase").alias("session_has_purchase"))
    return attach(flagged, sessions, ["session_id"])
