"""Calendar attributes (ISO weeks, Monday = 1) and tolerant parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.numbers import as_column

EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][X]"


def parse_date(value: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Date, or null when the text is not one."""
    return F.try_to_date(as_column(value), fmt)


def parse_event_time(value: Column | str) -> Column:
    """Event time with or without a trailing zone, or null."""
    return F.try_to_timestamp(as_column(value), F.lit(EVENT_TIME_FORMAT))


def iso_day_of_week(day: Column | str) -> Column:
    return F.weekday(as_column(day)) + 1


def iso_year(day: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), as_column(day)).cast("int")


def week_start(day: Column | str) -> Column:
    return F.trunc(as_column(day), "week")


def month_start(day: Column | str) -> Column:
    return F.trunc(as_column(day), "month")


def month_index(day: Column | str) -> Column:
    """Months since year 0, so that differences are whole months."""
    day = as_column(day)
    return F.year(day) * 12 + F.month(day)


def is_weekend(day: Column | str) -> Column:
    return F.weekday(as_column(day)) >= 5


def with_calendar_columns(df: DataFrame, day: str) -> DataFrame:
    """The calendar features every demand row carries."""
    return df.withColumns({
        "day_of_week": iso_day_of_week(day),
        "week_of_year": F.weekofyear(day),
        "month_num": F.month(day),
        "quarter": F.quarter(day),
        "year": F.year(day),
    })
