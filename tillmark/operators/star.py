"""Dimensions, fact load and the star join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.dates import is_weekend, iso_day_of_week, iso_year
from tillmark.functions.numbers import MONEY, cents
from tillmark.functions.ordering import first_per_key, numbered_after
from tillmark.operators.clean import require, with_measures, with_parsed_date
from tillmark.operators.enrich import with_holidays
from tillmark.operators.merge import merge_upsert
from tillmark.session import materialised


def calendar_days(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of each row of ``bounds``."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date"))


def calendar_dim(bounds: DataFrame, holidays: DataFrame | None = None, fiscal_start_month: int = 1) -> DataFrame:
    """The time dimension.  Keys count days from 1, so they do not need numbering."""
    day = F.col("full_date")
    shifted = F.add_months(day, (13 - fiscal_start_month) % 12)
    days = calendar_days(bounds).distinct().select(
        "full_date",
        (F.datediff(day, F.lit("1900-01-01").cast("date")) + 1).alias("time_key"),
        iso_day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        iso_year(day).alias("iso_year"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        is_weekend(day).alias("is_weekend"),
        (F.dayofmonth(day) == 1).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
        F.year(shifted).alias("fiscal_year"),
        F.quarter(shifted).alias("fiscal_quarter"),
    )
    return with_holidays(days, holidays, "full_date")


def first_seen(df: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[str],
               day: str | None = None, latest: bool = True) -> DataFrame:
    """One row per key with the attributes it was first seen with.

    With ``day``, those of its latest (or earliest) day of delivery: what loading the
    days one after the other would leave.
    """
    rows = require(df, [key])
    if day:
        back = F.datediff(F.lit("1970-01-01").cast("date"), F.col(day))
        rows = rows.withColumn("_turn", back if latest else -back)
    order = (["_turn"] if day else []) + list(order_by)
    rows = rows.select(key, *columns, *[c for c in order if c not in columns and c != key])
    return first_per_key(rows, [key], order).select(key, *columns)


def assign_keys(dim: DataFrame, incoming: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Incoming rows with their surrogate key: known ids keep theirs, new ids follow the highest."""
    known = dim.select(key, surrogate)
    # The highest key is a single number.
    highest = dim.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    new = numbered_after(incoming.join(known, key, "left_anti"), int(highest), [key], surrogate)
    return incoming.join(known, key).unionByName(new)


def upsert_dim(dim: DataFrame, incoming: DataFrame, key: str, surrogate: str,
               update_cols: Sequence[str] | None = None) -> DataFrame:
    """Type 1 upsert: surrogate keys stay, the chosen attributes are overwritten."""
    columns = [c for c in incoming.columns if c != key]
    return merge_upsert(dim, assign_keys(dim, incoming, key, surrogate), [key],
                        list(update_cols) if update_cols is not None else columns)


def upsert_products(dim: DataFrame, sales: DataFrame, order_by: Sequence[str], day: str | None = None) -> DataFrame:
    """Products as the sales show them; ``day`` names the day of delivery when there may be several."""
    columns = ["product_name", "category", "brand", "unit_price"]
    incoming = materialised(first_seen(sales, "product_id", columns, order_by, day))
    return upsert_dim(dim, incoming, "product_id", "product_key")


def upsert_stores(dim: DataFrame, sales: DataFrame, order_by: Sequence[str], day: str | None = None) -> DataFrame:
    """Known stores change name and city only; a new one keeps the state and region of its first delivery."""
    changing, fixed = ["store_name", "city"], ["state", "region"]
    if day:
        incoming = first_seen(sales, "store_id", changing, order_by, day).join(
            first_seen(sales, "store_id", fixed, order_by, day, latest=False), "store_id")
    else:
        incoming = first_seen(sales, "store_id", changing + fixed, order_by)
    return upsert_dim(dim, materialised(incoming), "store_id", "store_key", changing)


def fact_rows(sales: DataFrame, products: DataFrame, stores: DataFrame, calendar: DataFrame,
              key: Sequence[str] = ("transaction_id",), batch_id: str | None = None) -> DataFrame:
    """Sales lines with surrogate keys and measures; lines without all three keys are left out.

    Only keys, date and quantity are checked here; `clean.clean_pos` has the full rules.
    Cost and profit follow from the products' ``cost_price``; without that column they are null.
    """
    lines = require(with_parsed_date(sales), ["transaction_id", "product_id", "store_id", "transaction_date"]).filter("quantity > 0")
    delivered = ["source_day"] if "source_day" in lines.columns else []
    measured = with_measures(first_per_key(lines, list(key), [*delivered, "transaction_date"]))
    price = F.col("cost_price").cast(MONEY) if "cost_price" in products.columns else F.lit(None).cast(MONEY)
    cost = (F.col("quantity") * F.col("_unit_cost")).cast(MONEY)
    keyed = (
        measured.join(products.select("product_id", "product_key", price.alias("_unit_cost")), "product_id")
        .join(stores.select("store_id", "store_key"), "store_id")
        .join(calendar.select(F.col("full_date").alias("transaction_date"), "time_key"), "transaction_date")
    )
    return keyed.select(
        "time_key", "product_key", "store_key", *key, "customer_id", "payment_method",
        F.lit("store").alias("channel"), F.col("quantity").alias("quantity_sold"), "unit_price",
        "discount_amount", "gross_revenue", "net_revenue", cost.alias("cost_of_goods"),
        (F.col("net_revenue") - cost).cast(MONEY).alias("gross_profit"), F.lit("pos").alias("source_system"),
        F.current_timestamp().alias("load_timestamp"), F.lit(batch_id).cast("string").alias("batch_id"),
    )


def sales_rows(facts: DataFrame, products: DataFrame, stores: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Stored facts as the sales rows the analytics take: ids for keys, dates, money in cents.

    The calendar is needed only where the facts do not store their sale date.
    """
    keyed = (facts.join(products.select("product_key", "product_id"), "product_key")
             .join(stores.select("store_key", "store_id"), "store_key"))
    if calendar is not None:
        keyed = keyed.join(calendar.select("time_key", F.col("full_date").alias("sale_date")), "time_key")
    return with_cents(keyed)


def with_cents(sales: DataFrame) -> DataFrame:
    """Money columns as whole cents under the names the analytics use."""
    names = {"gross_revenue": "gross_cents", "discount_amount": "discount_cents", "net_revenue": "net_cents",
             "gross_profit": "profit_cents"}
    return sales.withColumns({new: cents(old) for old, new in names.items() if old in sales.columns}).drop(*names)


def unmatched(sales: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows per key value that the dimension does not know.

    Rows are counted per value before the join: a hot value is one row by then.
    """
    counts = sales.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(dim.select(key).distinct(), key, "left_anti")


def star(sales: DataFrame, *, products: DataFrame | None = None, stores: DataFrame | None = None,
         calendar: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """Sales with the wanted dimension columns; dimensions not passed are not joined."""
    joined = sales if where is None else sales.filter(where)
    if products is not None:
        joined = joined.join(products, "product_id")
    if stores is not None:
        joined = joined.join(stores, "store_id")
    if calendar is not None:
        joined = joined.join(calendar, joined["sale_date"] == calendar["full_date"]).drop("full_date")
    return joined
