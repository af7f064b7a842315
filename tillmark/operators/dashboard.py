"""The dashboard's slices and totals, over daily demand rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.dates import iso_year
from tillmark.functions.numbers import pct_change, ratio
from tillmark.functions.series import frame
from tillmark.schemas import DAILY_DEMAND_EXPORT


def slice_demand(daily: DataFrame, first: str | None = None, last: str | None = None,
                 category: str = "All", region: str = "All") -> DataFrame:
    """Rows of a date range, category and region; "All" and None do not filter."""
    if first:
        daily = daily.filter(F.col("agg_date") >= F.lit(first).cast("date"))
    if last:
        daily = daily.filter(F.col("agg_date") <= F.lit(last).cast("date"))
    if category != "All":
        daily = daily.filter(F.col("category") == category)
    if region != "All":
        daily = daily.filter(F.col("region") == region)
    return daily


def kpi_totals(daily: DataFrame) -> DataFrame:
    totals = daily.agg(F.sum("total_revenue").alias("total_revenue"), F.sum("total_quantity").alias("total_units"),
                       F.sum("total_orders").alias("total_orders"))
    return totals.withColumn("avg_order_value", ratio("total_revenue", F.greatest("total_orders", F.lit(1)), 2))


def kpi_change(daily: DataFrame, first: str, last: str) -> DataFrame:
    """KPI totals of a period against the equally long period before it, in one pass."""
    start, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
    before = start - (end - start) - dt.timedelta(days=1)
    now = F.col("agg_date") >= F.lit(start)
    both = daily.filter(F.col("agg_date").between(F.lit(before), F.lit(end)))
    sums = [F.sum(F.when(cond, F.col(c))).alias(f"{name}_{c}")
            for c in ("total_revenue", "total_quantity", "total_orders")
            for name, cond in (("now", now), ("before", ~now))]
    totals = both.agg(*sums)
    return totals.withColumns({
        f"{c}_change_pct": pct_change(f"now_{c}", f"before_{c}")
        for c in ("total_revenue", "total_quantity", "total_orders")})


def daily_trend(daily: DataFrame) -> DataFrame:
    """Totals per day with 7- and 30-row means; one row per day by the time of the window."""
    days = daily.groupBy("agg_date").agg(F.sum("total_quantity").alias("units"), F.sum("total_revenue").alias("revenue"))
    return days.withColumns({
        "rolling_7d": F.avg("units").over(frame(7, [], "agg_date", include_current=True)),
        "rolling_30d": F.avg("units").over(frame(30, [], "agg_date", include_current=True)),
    }).orderBy("agg_date")


def revenue_by_category(daily: DataFrame) -> DataFrame:
    return daily.groupBy("category").agg(F.sum("total_revenue").alias("total_revenue")).orderBy("total_revenue")


def demand_by_region(daily: DataFrame) -> DataFrame:
    return daily.groupBy("region").agg(F.sum("total_revenue").alias("revenue"), F.sum("total_quantity").alias("units"))


def weekday_month_pivot(daily: DataFrame) -> DataFrame:
    """Units by weekday (rows) and month (columns m1..m12), 0 where there are none."""
    grid = daily.groupBy("day_of_week").pivot("month_num", list(range(1, 13))).agg(F.sum("total_quantity"))
    return grid.select("day_of_week", *[F.coalesce(F.col(str(m)), F.lit(0)).alias(f"m{m}") for m in range(1, 13)])


def weekly_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy(iso_year("agg_date").alias("year"), F.weekofyear("agg_date").alias("week_of_year")).agg(
        F.sum("total_quantity").alias("total_quantity"), F.sum("total_revenue").alias("total_revenue"))


def top_products(daily: DataFrame, k: int) -> DataFrame:
    """The k products with the highest revenue; each task keeps only its own top k."""
    totals = daily.groupBy("product_id", "category").agg(
        F.sum("total_quantity").alias("units"), F.sum("total_revenue").alias("revenue"))
    return totals.orderBy(F.desc("revenue"), "product_id").limit(k)


def latest_rows(daily: DataFrame, n: int) -> DataFrame:
    """The n newest demand rows."""
    return daily.orderBy(F.desc("agg_date"), "product_id", "store_id").limit(n)


def serving_extract(daily: DataFrame) -> DataFrame:
    """The downloadable extract, in series order."""
    return daily.select(*DAILY_DEMAND_EXPORT).orderBy("product_id", "store_id", "agg_date")
