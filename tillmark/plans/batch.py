"""The nightly job and the backfill: raw files to facts, aggregates and features.

A range of days is loaded by the same jobs as one day.  Every table is written so
that running a range again gives the same tables: partitions are replaced, and
facts are only added for transactions not yet stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.dates import week_start
from tillmark.operators import analytics, clean, demand, enrich, features, merge, quality, star
from tillmark.operators.runlog import RunRecord, table_counts
from tillmark.session import materialised
from tillmark.sinks import lake as sinks
from tillmark.sources import files
from tillmark.streaming import events as ingest

PRODUCT_DIM = "product_id string, product_name string, category string, brand string, unit_price decimal(12,2), cost_price decimal(12,2), product_key bigint"
STORE_DIM = "store_id string, store_name string, city string, state string, region string, store_key bigint"


@dataclass(frozen=True)
class Layout:
    """Roots of the data lake and of the warehouse tables."""

    lake: str
    warehouse: str

    def table(self, name: str) -> str:
        return f"{self.warehouse}/{name}"


class GateClosed(RuntimeError):
    """No day of the range passed the checks before loading."""


def ensure_calendar(spark: SparkSession, layout: Layout, first: str, last: str, holidays: DataFrame | None) -> DataFrame:
    """The time dimension, widened to whole years around the range when it does not cover it."""
    path = layout.table("dim_time")
    start, end = dt.date(int(first[:4]), 1, 1), dt.date(int(last[:4]), 12, 31)
    if sinks.path_exists(spark, path):
        known = spark.read.parquet(path).agg(F.min("full_date"), F.max("full_date")).first()
        if known[0] <= start and known[1] >= end:
            return spark.read.parquet(path)
        start, end = min(start, known[0]), max(end, known[1])
    bounds = spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))
    sinks.replace_table(star.calendar_dim(bounds, holidays), path)
    return spark.read.parquet(path)


def load_dims(spark: SparkSession, layout: Layout, cleaned: DataFrame, costs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Type 1 upserts of products and stores from the cleaned lines.

    ``costs`` (product_id, cost_price) sets the cost of the products it names; the others keep theirs.  Facts take the
    cost that their product has when they are loaded.
    """
    order = ["transaction_date", "transaction_id"]
    for name, schema, upsert in (("dim_product", PRODUCT_DIM, star.upsert_products),
                                 ("dim_store", STORE_DIM, star.upsert_stores)):
        path = layout.table(name)
        rows = upsert(merge.read_if_exists(spark, path, schema), cleaned, order, "source_day")
        if costs is not None and name == "dim_product":
            known = costs.select("product_id", F.col("cost_price").cast("decimal(12,2)").alias("cost_price")).join(
                rows.select("product_id"), "product_id", "left_semi")
            rows = merge.merge_upsert(rows, known, ["product_id"], ["cost_price"])
        sinks.replace_table(rows, path)
    return spark.read.parquet(layout.table("dim_product")), spark.read.parquet(layout.table("dim_store"))


def load_facts(spark: SparkSession, layout: Layout, cleaned: DataFrame, products: DataFrame, stores: DataFrame,
               calendar: DataFrame, key: Sequence[str], run_id: str) -> str:
    """Add the transactions not stored yet, partitioned by sale date."""
    path = layout.table("fact_sales")
    rows = star.fact_rows(cleaned, products, stores, calendar, key, run_id).join(
        calendar.select("time_key", F.col("full_date").alias("sale_date")), "time_key")
    # Of the stored facts only the key columns are read.
    known = merge.read_if_exists(spark, path, rows.schema)
    (merge.insert_ignore(known, rows, key, as_small_as=cleaned).hint("rebalance", "sale_date")
     .write.mode("append").partitionBy("sale_date").parquet(path))
    return path


def aggregate(spark: SparkSession, layout: Layout, days: Sequence[dt.date], products: DataFrame, stores: DataFrame,
              weather: DataFrame | None, holidays: DataFrame | None) -> None:
    """Daily and weekly demand, and monthly product ranks, of the given days of sale, computed again from their facts.

    These are the days a load touched, late lines of older days among them.
    """
    sales = star.sales_rows(spark.read.parquet(layout.table("fact_sales")), products, stores)
    day = F.col("sale_date")

    daily = demand.daily_demand_table(sales, products, stores, holidays, where=day.isin(list(days)))
    located = daily.join(stores.select("store_id", "state"), "store_id")
    weathered = enrich.with_weather(located, weather, "agg_date", "state").drop("state", "weather_condition")
    sinks.write_partitions(weathered, layout.table("agg_daily_demand"), ["agg_date"])

    # The week after a touched week compares itself with it, and both with the week before.
    touched = {d - dt.timedelta(days=d.weekday()) for d in days}
    written = touched | {w + dt.timedelta(days=7) for w in touched}
    needed = written | {w - dt.timedelta(days=7) for w in touched}
    weekly = demand.with_week_over_week(demand.weekly_demand(sales, where=week_start(day).isin(sorted(needed))))
    kept = weekly.filter(F.col("week_start").isin(sorted(written)))
    sinks.write_partitions(demand.with_dims(kept, products, stores), layout.table("agg_weekly_demand"), ["week_start"])

    # Whole months of the touched days; the date range prunes the facts.
    months = sorted({d.replace(day=1) for d in days})
    monthly = analytics.monthly_ranks(sales.filter(F.trunc(day, "month").isin(months) & day.between(months[0], dt.date(
        max(days).year + max(days).month // 12, max(days).month % 12 + 1, 1))))
    sinks.write_partitions(monthly, layout.table("agg_product_rank"), ["year", "month_num"])


def export_features(spark: SparkSession, layout: Layout, as_of: str, lookback_days: int = 365) -> str:
    """The ML-ready table as CSV under the run date; refused when a target is negative."""
    daily = spark.read.parquet(layout.table("agg_daily_demand"))
    ready = features.ml_dataset(daily)
    if not features.export_allowed(ready):
        raise ValueError("negative demand in the features")
    return sinks.export_by_run_date(features.export_rows(ready, as_of, lookback_days), layout.lake, as_of)


def run_events(spark: SparkSession, layout: Layout, first: str, last: str | None = None) -> str:
    """The events of a day (or range) of the raw lake, cleaned, with their product and session, as processed events.

    Without a product dimension the events are written all the same, with nulls for what it would add.
    """
    raw = files.raw_events(spark, layout.lake, first, last, with_day=True)
    events = clean.clean_events(ingest.normalised(raw, "source_day"))
    path = layout.table("dim_product")
    products = spark.read.parquet(path) if sinks.path_exists(spark, path) else None
    whole = enrich.with_session_metrics(enrich.with_product(events, products))
    added = ["dim_category", "list_price", "is_purchase", "session_event_count", "session_has_purchase", "source_day"]
    return sinks.write_events(clean.event_projection(whole, *added), layout.lake)


def run_batch(spark: SparkSession, layout: Layout, first: str, last: str | None = None, *, run_id: str,
              key: Sequence[str] = ("transaction_id",), weather: DataFrame | None = None,
              holidays: DataFrame | None = None, costs: DataFrame | None = None,
              export_days: int | None = 365) -> DataFrame:
    """Load a day, or backfill an inclusive range of days.

    Days are gated one by one: a day that fails is left out and the others go on.  Without a fact of the loaded days
    nothing is aggregated.  The features of the last ``export_days`` are exported under the range's last day (None: not at all).
    Returns the post-load checks of the range's last day.
    """
    last = last or first
    run = RunRecord("pos_etl", run_id)
    metrics = layout.table("run_metrics")
    try:
        raw = files.raw_pos(spark, layout.lake, first, last)
        # One row per day.
        verdicts = materialised(quality.preload_gate_by_day(raw, "source_day"), "gate")
        sinks.append_check_log(_gate_log(verdicts), layout.warehouse, run_id, "pre_load")
        open_days = verdicts.filter("gate_open").select("source_day")
        if open_days.isEmpty():
            raise GateClosed(f"no day from {first} to {last} passed the checks before loading")

        admitted = run.observed(raw.join(F.broadcast(open_days), "source_day", "left_semi"),
                                rows_read=F.count(F.lit(1)))
        # Cleaned once; sales, dimensions and facts all read the result.  A transaction may come again on a later
        # day: the lake keeps both deliveries, the facts the first.
        cleaned = materialised(run.observed(clean.clean_pos(admitted, [*key, "source_day"]), rows_clean=F.count(F.lit(1))), "cleaned")
        sinks.write_sales(clean.sales_projection(cleaned, "source_day"), layout.lake)
        # Bounded by the calendar.
        days = sorted(r[0] for r in cleaned.select("transaction_date").distinct().collect())
        if not days:
            raise GateClosed(f"no line from {first} to {last} is left to load")

        calendar = ensure_calendar(spark, layout, first, last, holidays)
        products, stores = load_dims(spark, layout, cleaned, costs)
        load_facts(spark, layout, cleaned, products, stores, calendar, key, run_id)
        facts = spark.read.parquet(layout.table("fact_sales"))
        aggregated = not facts.filter(F.col("sale_date").isin(days)).isEmpty()
        if aggregated:
            aggregate(spark, layout, days, products, stores, weather, holidays)
        checks = materialised(quality.post_load(star.with_cents(facts), products, last, product_key="product_key"), "checks")
        sinks.append_check_log(_post_load_log(checks), layout.warehouse, run_id, "post_load_check")
        quality.raise_on_failure(checks)
        if aggregated and export_days is not None:
            export_features(spark, layout, last, export_days)
        # One row per table.
        tables = ["fact_sales", "dim_product", "dim_store"] + ["agg_daily_demand", "agg_weekly_demand"] * aggregated
        for row in table_counts({name: spark.read.parquet(layout.table(name)) for name in tables}).collect():
            run.record(f"rows_{row['table_name']}", row["n_rows"])
        run.finish(spark, metrics)
        return checks
    except Exception as problem:
        run.error(f"{type(problem).__name__}: {problem}")
        run.finish(spark, metrics, "failed")
        raise


def _gate_log(verdicts: DataFrame) -> DataFrame:
    """The gate's verdicts as check results, one row per day and rule."""
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(limit).alias("threshold"), F.col(name).alias("ok"))
                               for name, limit in quality.gate_limits().items()]))
    return verdicts.select("source_day", "n", rows.alias("r")).select(
        "r.check_name", F.lit("pos_sales_raw").alias("table_name"), F.col("n").alias("total_records"), "r.threshold",
        F.when(F.col("r.ok"), "PASS").otherwise("FAIL").alias("status"), F.col("source_day").cast("string").alias("details"))


def _post_load_log(checks: DataFrame) -> DataFrame:
    return checks.select(
        "check_name", F.lit("fact_sales").alias("table_name"), F.col("value").alias("total_records"),
        F.when(F.col("status") == "PASS", 0).otherwise(F.col("value")).cast("long").alias("failed_records"), "status")
