"""Daily and weekly demand.

``sales`` rows carry sale_date, product_id, store_id, transaction_id,
quantity_sold, net_cents, gross_cents and discount_cents; see `star.sales_rows`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions.dates import iso_year, week_start, with_calendar_columns
from tillmark.functions.numbers import dollars, dollars_per, pct_change, ratio
from tillmark.operators.clean import clean_pos
from tillmark.operators.enrich import with_holidays
from tillmark.operators.star import with_cents

SERIES = ("product_id", "store_id")


def daily_demand(sales: DataFrame, keys: Sequence[str] = SERIES, where: Column | None = None) -> DataFrame:
    """Units, revenue, distinct orders, order value and discount rate per day and key."""
    rows = sales if where is None else sales.filter(where)
    totals = rows.groupBy(F.col("sale_date").alias("agg_date"), *keys).agg(
        F.sum("quantity_sold").alias("total_quantity"),
        F.sum("net_cents").alias("_net"),
        F.countDistinct("transaction_id").alias("total_orders"),
        F.sum("discount_cents").alias("_discount"),
        F.sum("gross_cents").alias("_gross"),
    )
    return daily_columns(totals)


def daily_columns(totals: DataFrame) -> DataFrame:
    """Daily sums with money in dollars, the rates and the calendar columns."""
    return with_calendar_columns(
        totals.withColumns({
            "total_revenue": dollars("_net"),
            "avg_order_value": dollars_per("_net", "total_orders"),
            "discount_rate": ratio("_discount", "_gross", 4),
        }).drop("_net", "_discount", "_gross"),
        "agg_date",
    )


def demand_rollup(daily: DataFrame) -> DataFrame:
    """Units and revenue of daily rows per region and category, per region, and in all; ``level`` is 0, 1 and 3."""
    return daily.rollup("region", "category").agg(
        F.grouping_id().alias("level"), F.sum("total_quantity").alias("total_quantity"), F.sum("total_revenue").alias("total_revenue"),
        F.count_distinct("agg_date").alias("days"))


def with_dims(daily: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Category and region.  Joined after the aggregation: both depend on the ids alone."""
    return (daily.join(products.select("product_id", "category"), "product_id")
            .join(stores.select("store_id", "region"), "store_id"))


def daily_demand_table(sales: DataFrame, products: DataFrame, stores: DataFrame,
                       holidays: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """The daily demand aggregate: product x store x day with category, region and holiday.

    Pass ``where`` (say, one sale date) for the incremental load.
    """
    return with_holidays(with_dims(daily_demand(sales, where=where), products, stores), holidays, "agg_date")


def daily_from_raw(raw: DataFrame, key: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """Daily demand straight from raw sales lines, where no warehouse exists yet.

    Cleaned and revenue recomputed by the same code as the fact load.
    """
    sales = with_cents(clean_pos(raw, key)).withColumnsRenamed({"transaction_date": "sale_date", "quantity": "quantity_sold"})
    return daily_demand(sales, [c for c in ("product_id", "store_id", "category", "region") if c in sales.columns])


def weekly_demand(sales: DataFrame, keys: Sequence[str] = SERIES, where: Column | None = None) -> DataFrame:
    """ISO-week totals with distinct orders of the week; the daily mean is over seven days."""
    rows = sales if where is None else sales.filter(where)
    weeks = rows.groupBy(week_start("sale_date").alias("week_start"), *keys).agg(
        F.sum("quantity_sold").alias("total_quantity"),
        dollars(F.sum("net_cents")).alias("total_revenue"),
        F.countDistinct("transaction_id").alias("total_orders"),
    )
    return _with_week_columns(weeks)


def weekly_from_daily(daily: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """ISO-week totals of daily rows; orders spanning days count once per day."""
    weeks = daily.groupBy(week_start("agg_date").alias("week_start"), *keys).agg(
        F.sum("total_quantity").alias("total_quantity"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
    )
    return _with_week_columns(weeks)


def _with_week_columns(weeks: DataFrame) -> DataFrame:
    return weeks.withColumns({
        "year": iso_year("week_start"),
        "week_of_year": F.weekofyear("week_start"),
        "avg_daily_qty": ratio("total_quantity", F.lit(7), 2),
    })


def with_week_over_week(weekly: DataFrame, keys: Sequence[str] = SERIES, mode: str = "calendar") -> DataFrame:
    """Previous week's quantity and the change in percent.

    ``mode="calendar"``: the week before, null if it had no sales.
    ``mode="row"``: the last week that had any.
    """
    w = Window.partitionBy(*keys).orderBy("week_start")
    before = F.lag("total_quantity").over(w)
    if mode == "calendar":
        before = F.when(F.lag("week_start").over(w) == F.date_sub("week_start", 7), before)
    return (weekly.withColumn("prev_week_qty", before)
            .withColumn("wow_change_pct", pct_change("total_quantity", "prev_week_qty", 4)))


def weekly_demand_for(sales: DataFrame, as_of: str, keys: Sequence[str] = SERIES) -> DataFrame:
    """The last full week before ``as_of`` with its week-over-week change, for the incremental load.

    Reads the two weeks needed; the date predicate prunes partitions.
    """
    this_week = week_start(F.lit(as_of).cast("date"))
    recent = (F.col("sale_date") >= F.date_sub(this_week, 14)) & (F.col("sale_date") < this_week)
    return (with_week_over_week(weekly_demand(sales, keys, recent), keys)
            .filter(F.col("week_start") == F.date_sub(this_week, 7)))
