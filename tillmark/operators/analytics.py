"""The business queries and the analytical views.

Dates relative to "today" take an explicit ``as_of`` date.  Columns of ``sales``
as in `demand`, plus customer_id and channel; margins need profit_cents.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions.dates import month_index, month_start
from tillmark.functions.numbers import dollars, dollars_per, pct_change, ratio, sample_std, squared
from tillmark.functions.ordering import rank_within, running_total
from tillmark.functions.series import frame
from tillmark.operators.star import star


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Revenue, units and transactions per month with the change on the previous month."""
    monthly = (
        sales.groupBy(F.year("sale_date").alias("year"), F.month("sale_date").alias("month_num"))
        .agg(F.sum("net_cents").alias("_net"), F.sum("quantity_sold").alias("units_sold"),
             F.countDistinct("transaction_id").alias("transactions"))
    )
    # One row per month of the calendar, so one window partition is enough.
    w = Window.orderBy("year", "month_num")
    return (
        monthly.withColumn("month_label", F.date_format(F.make_date("year", "month_num", F.lit(1)), "MMM yyyy"))
        .withColumn("_before", F.lag("_net").over(w))
        .withColumns({"revenue": dollars("_net"), "prev_month_revenue": dollars("_before"),
                      "mom_change_pct": pct_change("_net", "_before")})
        .drop("_net", "_before").orderBy("year", "month_num")
    )


def top_products_by_category(sales: DataFrame, products: DataFrame, as_of: str, days: int = 30, k: int = 10) -> DataFrame:
    """The k best-selling products of each category over the last days; ties share a rank."""
    recent = sales.filter(F.col("sale_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    totals = recent.groupBy("product_id").agg(
        F.sum("quantity_sold").alias("units_sold_30d"), F.sum("net_cents").alias("_net"))
    # Filtering on the rank lets Spark cut each category to its top k before the shuffle.
    w = Window.partitionBy("category").orderBy(F.desc("_net"))
    return (
        totals.join(products.select("product_id", "product_name", "category"), "product_id")
        .withColumn("rank_in_category", F.rank().over(w)).filter(F.col("rank_in_category") <= k)
        .withColumn("revenue_30d", dollars("_net")).drop("_net")
        .orderBy("category", "rank_in_category", "product_id")
    )


def _quarter(day: dt.date) -> tuple[dt.date, dt.date]:
    """First day of the quarter and of the next one."""
    first = dt.date(day.year, 3 * ((day.month - 1) // 3) + 1, 1)
    after = dt.date(first.year + (first.month == 10), first.month % 12 + 3 if first.month != 10 else 1, 1)
    return first, after


def store_scorecard(sales: DataFrame, stores: DataFrame, as_of: str, key: str = "store_id") -> DataFrame:
    """Each store's quarter against the same quarter last year.

    Both quarters come from one scan of just those dates.
    """
    first, after = _quarter(dt.date.fromisoformat(as_of))
    prior_first, prior_after = first.replace(year=first.year - 1), after.replace(year=after.year - 1)
    day = F.col("sale_date")
    current = (day >= F.lit(first)) & (day < F.lit(after))
    prior = (day >= F.lit(prior_first)) & (day < F.lit(prior_after))
    totals = sales.filter(current | prior).groupBy(key).agg(
        F.sum(F.when(current, F.col("net_cents"))).alias("_now"),
        F.sum(F.when(current, F.col("quantity_sold"))).alias("units_qtd"),
        F.countDistinct(F.when(current, F.col("customer_id"))).alias("customers_qtd"),
        F.sum(F.when(prior, F.col("net_cents"))).alias("_before"),
        F.count_if(current).alias("_lines"),
    ).filter("_lines > 0").drop("_lines")
    return (
        totals.join(stores.select(key, "store_name", "region"), key)
        .withColumns({"revenue_qtd": dollars("_now"), "revenue_prior_qtd": dollars("_before"),
                      "yoy_growth_pct": pct_change("_now", "_before")})
        .drop("_now", "_before").orderBy(F.desc("revenue_qtd"))
    )


def demand_signals(daily: DataFrame, as_of: str, keys: Sequence[str] = ("product_id", "store_id"),
                   include_tested_day: bool = True) -> DataFrame:
    """Series whose last day lies more than two deviations off its 31-day mean.

    One aggregation gives the statistics and the tested day together.
    """
    end = F.date_sub(F.lit(as_of).cast("date"), 1)
    tested = F.col("agg_date") == end
    sample = F.lit(True) if include_tested_day else ~tested
    qty = F.when(sample, F.col("total_quantity").cast("long"))
    stats = (
        daily.filter(F.col("agg_date").between(F.date_sub(F.lit(as_of).cast("date"), 31), end))
        .groupBy(*keys)
        .agg(F.max(F.when(tested, F.col("total_quantity"))).alias("today_qty"), F.count(qty).alias("_n"),
             F.sum(qty).alias("_sum"), F.sum(squared(qty)).alias("_squares"))
        .filter("today_qty is not null")
        .withColumn("_mean", F.col("_sum").cast("double") / F.nullif("_n", F.lit(0)))
        .withColumn("_std", sample_std(F.col("_n"), F.col("_sum"), F.col("_squares")))
        .withColumn("_z", (F.col("today_qty") - F.col("_mean")) / F.nullif("_std", F.lit(0.0)))
        .filter(F.abs("_z") > 2)
    )
    signal = (F.when(F.col("_z") > 3, "EXTREME_SPIKE").when(F.col("_z") > 2, "SPIKE")
              .when(F.col("_z") < -2, "DIP").otherwise("NORMAL"))
    return stats.select(
        *keys, "today_qty", ratio("_sum", "_n", 1).alias("avg_30d"), F.round("_std", 1).alias("std_30d"),
        F.round("_z", 2).alias("z_score"), signal.alias("demand_signal"),
    ).orderBy(F.desc("z_score"))


def holiday_impact(sales: DataFrame, products: DataFrame, calendar: DataFrame) -> DataFrame:
    """Units and revenue per sales row on holidays and other days, per category.

    ``avg_daily_*`` average rows; ``units_per_day`` divides by the number of days.
    """
    # Lines are summed per product and day before anything is joined.
    sums = sales.groupBy("product_id", "sale_date").agg(
        F.sum("quantity_sold").alias("_units"), F.sum("net_cents").alias("_net"), F.count(F.lit(1)).alias("_rows"))
    joined = star(sums, products=products.select("product_id", "category"),
                  calendar=calendar.select("full_date", "is_holiday", "holiday_name"))
    return (
        joined.groupBy("category", "is_holiday", "holiday_name", "sale_date")
        .agg(F.sum("_units").alias("_units"), F.sum("_net").alias("_net"), F.sum("_rows").alias("_rows"))
        .groupBy("category", "is_holiday", "holiday_name")
        .agg(F.sum("_units").alias("_units"), F.sum("_net").alias("_net"),
             F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("num_days"))
        .select("category", "is_holiday", "holiday_name",
                ratio("_units", "_rows", 2).alias("avg_daily_units"),
                dollars_per("_net", "_rows").alias("avg_daily_revenue"),
                "num_days", ratio("_units", "num_days", 2).alias("units_per_day"))
        .orderBy("category", F.desc("is_holiday"), "holiday_name")
    )


def customer_cohorts(sales: DataFrame) -> DataFrame:
    """Active customers by first-purchase month and months since.

    Rows shrink to one per customer and month before the first shuffle, so an
    account used for a third of all sales is a few hundred rows.
    """
    active = (sales.filter("customer_id is not null")
              .select("customer_id", month_start("sale_date").alias("month")).distinct())
    first = F.min("month").over(Window.partitionBy("customer_id"))
    return (
        active.withColumn("cohort_month", first)
        .groupBy(F.date_format("cohort_month", "yyyy-MM").alias("cohort"),
                 (month_index("month") - month_index("cohort_month")).alias("month_number"))
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .orderBy("cohort", "month_number")
    )


def abc_classes(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Products by cumulative revenue share: A to 80 %, B to 95 %, C the rest."""
    revenue = sales.groupBy("product_id").agg(F.sum("net_cents").alias("_net"))
    ordered = running_total(
        revenue.join(products.select("product_id"), "product_id", "left_semi"),
        [F.col("_net").desc(), F.col("product_id").asc()], "_net", total="_all")
    running, total = F.col("running_total").cast("decimal(22,0)"), F.col("_all").cast("decimal(22,0)")
    return ordered.join(products.select("product_id", "product_name", "category"), "product_id").select(
        "product_id", "product_name", "category", dollars("_net").alias("total_revenue"),
        ratio("_net", "_all", 2, factor=100).alias("revenue_pct"),
        ratio("running_total", "_all", 2, factor=100).alias("cumulative_pct"),
        F.when(running * 100 <= total * 80, "A").when(running * 100 <= total * 95, "B").otherwise("C").alias("abc_class"),
    ).orderBy(F.desc("total_revenue"), "product_id")


def channel_mix(sales: DataFrame) -> DataFrame:
    """Share of each month's revenue per channel."""
    mix = sales.groupBy(F.year("sale_date").alias("year"), F.month("sale_date").alias("month_num"), "channel").agg(
        F.sum("net_cents").alias("_net"), F.sum("quantity_sold").alias("units"))
    # A month holds one row per channel by now.
    month = F.sum("_net").over(Window.partitionBy("year", "month_num"))
    return (mix.withColumns({"revenue": dollars("_net"), "channel_revenue_pct": ratio("_net", month, 2, factor=100)})
            .drop("_net").orderBy("year", "month_num", "channel"))


def discount_effectiveness(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Volume and revenue per row by category and discount band."""
    share = F.col("discount_cents") / F.nullif("gross_cents", F.lit(0))
    band = (F.when(F.col("discount_cents") == 0, "No discount")
            .when(share < 0.10, "<10%").when(share < 0.20, "10-20%").otherwise(">20%"))
    # Four rows per product at most are left when the category is joined.
    per_product = sales.groupBy("product_id", band.alias("discount_band")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("quantity_sold").alias("_units"), F.sum("net_cents").alias("_net"),
        F.sum("profit_cents").alias("_profit"), F.count("profit_cents").alias("_with_profit"))
    return (
        per_product.join(products.select("product_id", "category"), "product_id").groupBy("category", "discount_band")
        .agg(F.sum("_rows").alias("num_transactions"),
             ratio(F.sum("_units"), F.sum("_rows"), 2).alias("avg_quantity"),
             dollars_per(F.sum("_net"), F.sum("_rows")).alias("avg_net_revenue"),
             dollars_per(F.sum("_profit"), F.sum("_with_profit")).alias("avg_gross_profit"))
        .orderBy("category", "discount_band")
    )


def slow_movers(sales: DataFrame, products: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Active products last sold more than ``days`` ago, or never.

    Sales are reduced to a date per product before the join.
    """
    day = F.lit(as_of).cast("date")
    last = sales.groupBy("product_id").agg(F.max("sale_date").alias("last_sale_date"))
    return (
        products.filter("is_active").join(last, "product_id", "left")
        .filter(F.col("last_sale_date").isNull() | (F.col("last_sale_date") < F.date_sub(day, days)))
        .select("product_id", "product_name", "category", "unit_price", "last_sale_date",
                F.datediff(day, "last_sale_date").alias("days_since_last_sale"))
        .orderBy(F.desc_nulls_first("days_since_last_sale"))
    )


def with_product_names(ranks: DataFrame, products: DataFrame) -> DataFrame:
    return ranks.join(products.select("product_id", "product_name", "category"), "product_id")


def monthly_product_rank(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Every product's revenue rank in each month."""
    return with_product_names(monthly_ranks(sales), products)


def monthly_ranks(sales: DataFrame) -> DataFrame:
    """Units, revenue and revenue rank per product and month.  A month's ranks need that month's sales only."""
    totals = sales.groupBy(
        "product_id", F.year("sale_date").alias("year"), F.month("sale_date").alias("month_num"),
    ).agg(F.sum("quantity_sold").alias("units_sold"), F.sum("net_cents").alias("_net"))
    ranked = rank_within(totals, ["year", "month_num"], "_net", "revenue_rank")
    return ranked.withColumn("revenue", dollars("_net")).drop("_net")


def store_performance(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Per store and quarter: units, revenue, margin, transactions and customers."""
    totals = sales.groupBy("store_id", F.year("sale_date").alias("year"), F.quarter("sale_date").alias("quarter")).agg(
        F.sum("quantity_sold").alias("units_sold"), F.sum("net_cents").alias("_net"),
        F.sum("profit_cents").alias("_profit"),
        F.countDistinct("transaction_id").alias("num_transactions"),
        F.countDistinct("customer_id").alias("unique_customers"))
    return (totals.withColumns({"total_revenue": dollars("_net"), "gross_profit": dollars("_profit"),
                                "gross_margin_pct": ratio("_profit", "_net", 2, factor=100)})
            .drop("_net", "_profit").join(stores.select("store_id", "store_name", "region", "city"), "store_id"))


def category_trend(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Daily units and revenue per category with 7- and 30-row means including the day."""
    sums = sales.groupBy("product_id", "sale_date").agg(
        F.sum("quantity_sold").alias("_units"), F.sum("net_cents").alias("_net"))
    daily = (
        star(sums, products=products.select("product_id", "category"))
        .groupBy(F.col("sale_date").alias("full_date"), "category")
        .agg(F.sum("_units").alias("daily_units"), dollars(F.sum("_net")).alias("daily_revenue"))
    )
    return daily.withColumns({
        "rolling_7d_avg_units": F.avg("daily_units").over(frame(7, ["category"], "full_date", include_current=True)),
        "rolling_30d_avg_units": F.avg("daily_units").over(frame(30, ["category"], "full_date", include_current=True)),
    })
