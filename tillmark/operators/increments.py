"""Demand kept up by what changes: lines that come in and lines that are withdrawn.

The stored partials have one row per day, product, store and transaction with sums
that can be added and taken away, so a load adds its own partials to those of the
months it touches and reads no others.  Distinct orders are the rows that are left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.dates import month_start
from tillmark.operators import demand
from tillmark.sinks.once import change_once, stored

KEYS = ["month", "sale_date", "product_id", "store_id", "transaction_id"]
SUMS = ["lines", "quantity_sold", "net_cents", "gross_cents", "discount_cents"]


def partials(sales: DataFrame, sign: int = 1) -> DataFrame:
    """Sales summed per day, series and transaction; with ``sign`` -1 to take them away."""
    dated = sales.withColumn("month", month_start("sale_date")).withColumn("lines", F.lit(1).cast("long"))
    return dated.groupBy(*KEYS).agg(*[(F.sum(c) * sign).cast("long").alias(c) for c in SUMS])


def apply_lines(spark: SparkSession, path: str, stream: str, load: int, inserted: DataFrame, withdrawn: DataFrame | None = None) -> bool:
    """Add the inserted lines to the partials and take the withdrawn ones away, once per load number.

    A line that is corrected is withdrawn as it was and inserted as it is.
    """
    def change() -> tuple[DataFrame, list[str]]:
        delta = partials(inserted)
        if withdrawn is not None:
            delta = delta.unionByName(partials(withdrawn, -1))
        delta = delta.persist()
        # Bounded by the calendar.
        months = [r[0] for r in delta.select("month").distinct().collect()]
        held = stored(spark, path, delta.schema).filter(F.col("month").isin(months))
        summed = held.unionByName(delta).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        return summed.filter("lines <> 0"), [str(m) for m in months]

    return change_once(spark, path, stream, load, "month", change)


def daily_demand(orders: DataFrame, keys: Sequence[str] = demand.SERIES) -> DataFrame:
    """The daily demand of stored partials, equal to `demand.daily_demand` of their lines."""
    return demand.daily_columns(orders.groupBy(F.col("sale_date").alias("agg_date"), *keys).agg(
        F.sum("quantity_sold").alias("total_quantity"), F.sum("net_cents").alias("_net"),
        # A transaction is one row per day and series, unless the keys are coarser than a series.
        (F.count(F.lit(1)) if set(keys) >= set(demand.SERIES) else F.countDistinct("transaction_id")).alias("total_orders"),
        F.sum("discount_cents").alias("_discount"), F.sum("gross_cents").alias("_gross")))
