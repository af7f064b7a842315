"""Lag and rolling features, and their validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.numbers import ratio
from tillmark.functions.series import frame, lagged, trailing_mean, trailing_std
from tillmark.operators.demand import SERIES
from tillmark.schemas import FEATURE_EXPORT
from tillmark.session import materialised

LAGS = (7, 14, 28)


def with_lag_features(daily: DataFrame, keys: Sequence[str] = SERIES, value: str = "total_quantity",
                      mode: str = "rows", min_periods: tuple[int, int] = (1, 1), std: bool = True) -> DataFrame:
    """Lags of 7, 14 and 28 and trailing means of 7 and 28, without the current row.

    ``mode="rows"`` counts present days, ``"calendar"`` counts days of the calendar.
    A mean over fewer than ``min_periods`` values is null.
    """
    def trailing(steps: int):
        return frame(steps, keys, "agg_date", mode)

    columns = {f"demand_lag_{k}d": lagged(value, k, keys, "agg_date", mode) for k in LAGS}
    columns["rolling_avg_7d"] = trailing_mean(value, trailing(7), min_periods[0])
    columns["rolling_avg_28d"] = trailing_mean(value, trailing(28), min_periods[1])
    if std:
        columns["rolling_std_7d"] = trailing_std(value, trailing(7))
    return daily.withColumns(columns)


def densify(daily: DataFrame, keys: Sequence[str], value: str, day: str = "agg_date") -> DataFrame:
    """Every day between a series' first and last, 0 where there was no row."""
    spans = daily.groupBy(*keys).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    grid = spans.select(*keys, F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias(day))
    return grid.join(daily.select(*keys, day, value), [*keys, day], "left").fillna(0, [value])


def ml_dataset(daily: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """The ML-ready table: target, calendar, holiday flag, lags, rolling means, weather."""
    return (with_lag_features(daily, keys, std=False)
            .withColumn("is_holiday_flag", F.col("is_holiday").cast("int"))
            .withColumnRenamed("total_quantity", "target_demand"))


def export_rows(features: DataFrame, as_of: str, lookback_days: int) -> DataFrame:
    """The export's columns for the days from ``as_of - lookback_days`` on, in series order."""
    recent = F.col("agg_date") >= F.date_sub(F.lit(as_of).cast("date"), lookback_days)
    return (features.filter(recent).withColumn("is_holiday", F.col("is_holiday").cast("int"))
            .select(*FEATURE_EXPORT).orderBy("product_id", "store_id", "agg_date"))


def null_rates(df: DataFrame) -> DataFrame:
    """Share of nulls per column, only columns that have any.  One pass over the data."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls"), F.col("_rows")) for c in df.columns]))
    return (counted.select(rows.alias("r")).select("r.*").filter("nulls > 0")
            .select("column_name", ratio("nulls", "_rows", 4).alias("null_rate")))


def target_stats(df: DataFrame, target: str = "target_demand") -> DataFrame:
    value = F.col(target)
    return df.agg(
        ratio(F.sum(value), F.count(value), 2).alias("mean"),
        F.round(F.stddev_samp(value), 2).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count_if(value == 0).alias("zeros"),
        F.count_if(value < 0).alias("neg"),
    )


def feature_report(df: DataFrame, target: str = "target_demand") -> DataFrame:
    """Lag coverage, date range and cardinality in one row."""
    all_lags = F.lit(True)
    for k in LAGS:
        all_lags = all_lags & F.col(f"demand_lag_{k}d").isNotNull()
    # One row per series first; the distinct counts then read those rows, each by itself, not the days three times over.
    names = {"products": "product_id", "stores": "store_id", "categories": "category"}
    series = materialised(df.groupBy(*names.values()).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(all_lags).alias("_lagged"), F.min("agg_date").alias("start_date"),
        F.max("agg_date").alias("end_date")), "series")
    totals = series.agg(F.sum("_rows").alias("rows"), F.sum("_lagged").alias("_lagged"), F.min("start_date").alias("start_date"),
                        F.max("end_date").alias("end_date"))
    for alias, column in names.items():
        totals = totals.unionByName(series.agg(F.countDistinct(column).alias(alias)), allowMissingColumns=True)
    # A few one-row results folded into one.
    whole = totals.agg(*[F.max(c).alias(c) for c in totals.columns])
    return whole.select(
        F.coalesce("rows", F.lit(0)).alias("rows"), ratio("_lagged", "rows", 2, factor=100).alias("lag_coverage_pct"), "start_date",
        "end_date", (F.datediff("end_date", "start_date") + 1).alias("days"), *names)


def export_allowed(df: DataFrame, target: str = "target_demand") -> bool:
    """False when any target is negative; stops at the first one found."""
    return df.filter(F.col(target) < 0).isEmpty()
