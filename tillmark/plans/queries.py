"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions import sketches
from tillmark.functions.dates import week_start
from tillmark.functions.joins import by_series, known_bytes, parts_of
from tillmark.functions.numbers import dollars, money
from tillmark.functions.ordering import first_per_key, numbered_after
from tillmark.operators import analytics, clean, dashboard, demand, enrich, features, forecast, increments, merge, quality, runlog, star
from tillmark.plans import batch
from tillmark.plans.tables import Tables
from tillmark.plans.views import register_views
from tillmark.schemas import RAW_POS
from tillmark.session import run_dir
from tillmark.sinks import lake, packing
from tillmark.sources import files, streams
from tillmark.streaming import events as ingest
from tillmark.streaming import progress, signals

# The day after the last order; every scale ends on 2001-08-01.
AS_OF = "2001-08-01"
FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"
QUARTER_AS_OF = "2001-06-30"
SIGNAL_AS_OF = "1997-02-02"
SPLIT_DAY = "1998-01-01"
SERIES = ["category", "region"]
HORIZON = 14
#: Event text that a micro-batch of files takes at most.
BATCH_BYTES = 1 << 30

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    """Numbers as bigint and double, for results that are compared by value."""
    def widened(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(field.name)
        return column
    return df.select(*[widened(f) for f in df.schema.fields])


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[build.__name__] = lambda spark, sf_dir: plain(build(Tables(spark, sf_dir)))
    return build


# -- business queries and views -------------------------------------------------

@query
def bq01_monthly_revenue(t: Tables) -> DataFrame:
    return analytics.monthly_revenue(t.sales())


@query
def bq02_top_products(t: Tables) -> DataFrame:
    return analytics.top_products_by_category(t.sales(), t.products(), AS_OF)


@query
def bq03_store_scorecard(t: Tables) -> DataFrame:
    return analytics.store_scorecard(t.sales(), t.stores(), QUARTER_AS_OF)


@query
def bq04_demand_signals(t: Tables) -> DataFrame:
    return analytics.demand_signals(_series_daily(t), SIGNAL_AS_OF, SERIES)


@query
def bq05_holiday_impact(t: Tables) -> DataFrame:
    return analytics.holiday_impact(t.sales(), t.products(), t.calendar())


@query
def bq06_customer_cohorts(t: Tables) -> DataFrame:
    return analytics.customer_cohorts(t.sales())


@query
def bq07_abc_classes(t: Tables) -> DataFrame:
    return analytics.abc_classes(t.sales(dated=False), t.products())


@query
def bq08_channel_mix(t: Tables) -> DataFrame:
    return analytics.channel_mix(t.sales())


@query
def bq09_discount_effectiveness(t: Tables) -> DataFrame:
    return analytics.discount_effectiveness(t.sales(dated=False, cost=True), t.products())


@query
def bq10_slow_movers(t: Tables) -> DataFrame:
    return analytics.slow_movers(t.sales(), t.products(), AS_OF)


@query
def vw01_monthly_product_rank(t: Tables) -> DataFrame:
    return analytics.monthly_product_rank(t.sales(), t.products())


@query
def vw02_store_performance(t: Tables) -> DataFrame:
    return analytics.store_performance(t.sales(cost=True), t.stores())


@query
def vw03_category_trend(t: Tables) -> DataFrame:
    return analytics.category_trend(t.sales(), t.products())


@query
def vw04_ml_dataset(t: Tables) -> DataFrame:
    daily = demand.daily_demand_table(t.sales(), t.products(), t.stores(), t.holidays())
    located = daily.join(t.stores().select("store_id", "state"), "store_id")
    weathered = enrich.with_weather(located, t.weather(), "agg_date", "state").drop("state", "weather_condition")
    return _features(t, weathered)


@query
def adhoc_sql_over_views(t: Tables) -> DataFrame:
    """SQL over the registered views: each region's quarters, next to the number of top product months."""
    path = f"{run_dir(t.spark, 'ranks')}/t"
    lake.write_partitions(analytics.monthly_ranks(t.sales()), path, ["year", "month_num"])
    register_views(t.sales(cost=True), t.products(), t.stores(), _daily(t), ranks=t.spark.read.parquet(path))
    return t.spark.sql("""
        SELECT region, year, quarter, sum(units_sold) AS units, sum(total_revenue) AS revenue,
               (SELECT count(*) FROM v_top_products_monthly WHERE revenue_rank = 1) AS best_months
        FROM v_store_performance GROUP BY region, year, quarter""")


# -- demand ---------------------------------------------------------------------

def _daily(t: Tables) -> DataFrame:
    return demand.daily_demand_table(t.sales(), t.products(), t.stores(), t.holidays())


def _series_sales(t: Tables) -> DataFrame:
    return star.star(t.sales(), products=t.products().select("product_id", "category"),
                     stores=t.stores().select("store_id", "region"))


def _series_daily(t: Tables) -> DataFrame:
    """Daily demand per category and region: long, dense series."""
    return demand.daily_demand(_series_sales(t), SERIES)


@query
def daily_demand(t: Tables) -> DataFrame:
    return _daily(t)


@query
def daily_demand_from_raw(t: Tables) -> DataFrame:
    return demand.daily_from_raw(t.raw_pos())


@query
def daily_demand_incremental(t: Tables) -> DataFrame:
    """The sales up to a day with a month of them as first reported; then the corrections, and the sales from then on."""
    path, sales, day = f"{run_dir(t.spark, 'partials')}/t", t.sales(), F.col("sale_date")
    split = F.lit(SPLIT_DAY).cast("date")
    reported = sales.filter(day < split).withColumn("quantity_sold", F.col("quantity_sold") + F.when(day >= F.date_sub(split, 30), 1).otherwise(0))
    increments.apply_lines(t.spark, path, "sales", 0, reported)
    later = day >= F.date_sub(split, 30)
    increments.apply_lines(t.spark, path, "sales", 1, sales.filter(later), withdrawn=reported.filter(later))
    return increments.daily_demand(t.spark.read.parquet(path))


@query
def weekly_upsert(t: Tables) -> DataFrame:
    """Weekly demand as a table: the weeks up to a day, then the last of them and all later ones merged in by key."""
    path, day = f"{run_dir(t.spark, 'weekly')}/t", F.col("sale_date")
    split = week_start(F.lit(SPLIT_DAY).cast("date"))
    keys = ["year", "week_start", *demand.SERIES]
    # The first load has seen only the first days of its last week.
    for where in (day < F.date_add(split, 3), day >= split):
        merge.upsert_partitioned(demand.weekly_demand(t.sales(), where=where), path, keys, ["year"])
    return t.spark.read.parquet(path)


@query
def demand_rollup(t: Tables) -> DataFrame:
    return demand.demand_rollup(_series_daily(t))


@query
def weekly_customers_approx(t: Tables) -> DataFrame:
    """Customers per week and quarter from daily sketches, each beside the exact count, and whether the error is within its bound."""
    sales = t.sales()
    path = f"{run_dir(t.spark, 'sketches')}/t"
    sketches.with_sketch(sales, ["sale_date"], "customer_id", "customers").write.parquet(path)
    daily = t.spark.read.parquet(path)
    result = None
    for name, since in (("week", F.trunc("sale_date", "week")), ("quarter", F.trunc("sale_date", "quarter"))):
        approx = sketches.united(daily, [since.alias("since")], "customers", "approx")
        exact = sales.groupBy(since.alias("since")).agg(F.countDistinct("customer_id").alias("customers"))
        compared = exact.join(approx, "since").select(
            F.lit(name).alias("span"), "since", "customers",
            (F.abs(F.col("approx") - F.col("customers")) <= F.ceil(F.col("customers") * sketches.error_bound())).alias("within_bound"))
        result = compared if result is None else result.unionByName(compared)
    return result


@query
def weekly_demand_wow(t: Tables) -> DataFrame:
    return demand.with_week_over_week(demand.weekly_demand(_series_sales(t), SERIES), SERIES)


@query
def weekly_demand_product_store(t: Tables) -> DataFrame:
    return demand.with_week_over_week(by_series(demand.weekly_demand(t.sales()), demand.SERIES, t.parts()))


@query
def weekly_from_daily(t: Tables) -> DataFrame:
    return demand.with_week_over_week(demand.weekly_from_daily(_series_daily(t), SERIES), SERIES, mode="row")


@query
def weekly_last_week(t: Tables) -> DataFrame:
    return demand.weekly_demand_for(_series_sales(t), AS_OF, SERIES)


# -- features -------------------------------------------------------------------

@query
def lag_features(t: Tables) -> DataFrame:
    return features.with_lag_features(_series_daily(t), SERIES)


@query
def lag_features_calendar(t: Tables) -> DataFrame:
    return features.with_lag_features(_series_daily(t), SERIES, mode="calendar")


@query
def rolling_min_periods(t: Tables) -> DataFrame:
    daily = _series_daily(t).select("agg_date", *SERIES, "total_quantity")
    return features.with_lag_features(daily, SERIES, min_periods=(3, 7), std=False)


@query
def densified_series(t: Tables) -> DataFrame:
    return features.densify(_series_daily(t), SERIES, "total_quantity")


def _features(t: Tables, daily: DataFrame | None = None) -> DataFrame:
    daily = _daily(t) if daily is None else daily
    return features.ml_dataset(by_series(daily, demand.SERIES, t.parts()))


@query
def feature_null_rates(t: Tables) -> DataFrame:
    return features.null_rates(_features(t))


@query
def feature_target_stats(t: Tables) -> DataFrame:
    return features.target_stats(_features(t))


@query
def feature_report(t: Tables) -> DataFrame:
    return features.feature_report(_features(t))


@query
def export_gate(t: Tables) -> DataFrame:
    """Whether the features may be exported, as they are and with the returns taken as negative demand."""
    daily = _series_daily(t).withColumnsRenamed({"total_quantity": "target_demand"})
    returned = daily.withColumn("target_demand", F.col("target_demand") - 100)
    verdicts = [(name, features.export_allowed(df)) for name, df in (("sold", daily), ("returned", returned))]
    return t.spark.createDataFrame(verdicts, "features string, allowed boolean")


@query
def feature_export_files(t: Tables) -> DataFrame:
    """The export's rows as the daily CSV export holds them."""
    root = run_dir(t.spark, "export")
    first = t.order_span().first()["first_day"]
    weathered = enrich.with_mean_weather(_daily(t), t.weather(), "agg_date")
    rows = features.export_rows(_features(t, weathered), AS_OF, (dt.date.fromisoformat(AS_OF) - first).days)
    path = lake.export_by_run_date(rows, root, AS_OF)
    back = t.spark.read.schema(T.StructType([*rows.schema, T.StructField("dt", T.StringType())])).option("header", True).csv(path)
    return back.filter(F.col("dt") == AS_OF).groupBy("category", "region").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("target_demand").alias("units"), F.sum("total_orders").alias("orders"),
        F.count("demand_lag_28d").alias("lagged"))


@query
def export_latest(t: Tables) -> DataFrame:
    """Weekly totals exported as CSV and Parquet, each read from its latest copy."""
    root, rows, result = run_dir(t.spark, "exports"), dashboard.weekly_totals(_series_daily(t)), None
    for fmt in ("csv", "parquet"):
        _, latest = lake.export_dataset(rows, f"{root}/{fmt}", "2001-08-01", fmt)
        back = t.spark.read.schema(rows.schema).format(fmt).option("header", True).load(latest).withColumn("format", F.lit(fmt))
        result = back if result is None else result.unionByName(back)
    return result


@query
def dataset_replaced(t: Tables) -> DataFrame:
    """A named aggregate written twice: the second one takes the place of the first."""
    root, daily = run_dir(t.spark, "dataset"), _series_daily(t)
    lake.write_dataset(daily.groupBy("region").agg(F.lit(0).cast("long").alias("units")), root, "regions")
    path = lake.write_dataset(daily.groupBy("region").agg(F.sum("total_quantity").alias("units")), root, "regions")
    return t.spark.read.parquet(path)


@query
def weather_files(t: Tables) -> DataFrame:
    """Weather landed as a CSV of text and read back with its types."""
    path = run_dir(t.spark, "weather")
    null = F.lit(None).cast("string")
    (t.weather().select(
        F.date_format("weather_date", "yyyy-MM-dd").alias("date"), F.col("weather_state").alias("state"), F.col("temp_high_f").cast("string"),
        null.alias("temp_low_f"), F.col("precipitation_in").cast("string"), null.alias("snow_in"), F.col("weather_condition").alias("condition"))
     .write.option("header", True).csv(path))
    return files.weather(t.spark, path)


@query
def holiday_files(t: Tables) -> DataFrame:
    path = run_dir(t.spark, "holidays")
    t.holidays().select(F.date_format("holiday_date", "yyyy-MM-dd").alias("date"), "holiday_name", F.lit("True").alias("is_federal")).write.option(
        "header", True).csv(path)
    return files.holidays(t.spark, path).drop("is_holiday")


@query
def inferred_products(t: Tables) -> DataFrame:
    """Products from a CSV whose types Spark finds out, totalled."""
    path = run_dir(t.spark, "inferred")
    t.raw("part").select("p_partkey", "p_brand", "p_size", "p_retailprice").write.option("header", True).csv(path)
    found = files.inferred_csv(t.spark, path)
    return found.groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"), F.sum("p_size").alias("sizes"), F.max("p_retailprice").alias("dearest"))


@query
def feature_export(t: Tables) -> DataFrame:
    """The export's rows for the whole history, with the mean weather of the day."""
    weathered = enrich.with_mean_weather(_daily(t), t.weather(), "agg_date")
    first = t.order_span().first()["first_day"]
    return features.export_rows(_features(t, weathered), AS_OF, (dt.date.fromisoformat(AS_OF) - first).days)


# -- dashboard ------------------------------------------------------------------

@query
def kpi_totals(t: Tables) -> DataFrame:
    return dashboard.kpi_totals(_daily(t))


@query
def kpi_change(t: Tables) -> DataFrame:
    return dashboard.kpi_change(_series_daily(t), "1998-05-01", "2001-07-31")


@query
def daily_trend_ma(t: Tables) -> DataFrame:
    return dashboard.daily_trend(_series_daily(t))


@query
def revenue_by_category(t: Tables) -> DataFrame:
    return dashboard.revenue_by_category(_series_daily(t))


@query
def demand_by_region(t: Tables) -> DataFrame:
    return dashboard.demand_by_region(_series_daily(t))


@query
def dow_month_pivot(t: Tables) -> DataFrame:
    return dashboard.weekday_month_pivot(_series_daily(t))


@query
def weekly_totals(t: Tables) -> DataFrame:
    return dashboard.weekly_totals(_series_daily(t))


@query
def top15_products(t: Tables) -> DataFrame:
    return dashboard.top_products(_daily(t), 15)


@query
def latest_demand_rows(t: Tables) -> DataFrame:
    return dashboard.latest_rows(_daily(t), 10_000)


@query
def demand_slice(t: Tables) -> DataFrame:
    """A dashboard selection: two years of one category and one region."""
    return dashboard.slice_demand(_daily(t), "1997-01-01", "1998-12-31", "PROMO", "ASIA")


@query
def serving_extract(t: Tables) -> DataFrame:
    return dashboard.serving_extract(_daily(t))


# -- cleaning, joins, dimensions ------------------------------------------------

@query
def dedup_first(t: Tables) -> DataFrame:
    return first_per_key(t.raw_pos(), ["transaction_id"], ["transaction_date"])


@query
def clean_sales(t: Tables) -> DataFrame:
    return clean.with_time_features(clean.clean_pos(t.raw_pos()))


@query
def sales_fact_rows(t: Tables) -> DataFrame:
    return clean.sales_projection(clean.clean_pos(t.raw_pos()))


@query
def star_join(t: Tables) -> DataFrame:
    """Every sales line with its product, store and calendar columns, totalled by region, brand and month."""
    joined = star.star(t.sales(), products=t.products(), stores=t.stores(), calendar=t.calendar())
    return joined.groupBy("region", "brand", "year", "month_name", "is_weekend").agg(
        F.count(F.lit(1)).alias("lines"), dollars(F.sum("net_cents")).alias("revenue"))


def _located_sales(t: Tables) -> DataFrame:
    return t.sales().join(t.stores().select("store_id", "state"), "store_id")


@query
def weather_enrich(t: Tables) -> DataFrame:
    joined = enrich.with_weather(_located_sales(t), t.weather(), "sale_date", "state")
    return joined.select("transaction_id", "line_number", "product_id", "store_id", "sale_date", "state",
                         "temp_high_f", "precipitation_in", "weather_condition")


@query
def weather_match_rate(t: Tables) -> DataFrame:
    return quality.match_rate(enrich.with_weather(_located_sales(t), t.weather(), "sale_date", "state"), "temp_high_f")


@query
def weather_daily_mean(t: Tables) -> DataFrame:
    daily = _series_daily(t).select("agg_date", *SERIES, "total_quantity")
    return enrich.with_mean_weather(daily, t.weather(), "agg_date")


@query
def holiday_enrich(t: Tables) -> DataFrame:
    joined = enrich.with_holidays(t.sales(), t.holidays(), "sale_date")
    return joined.select("transaction_id", "line_number", "product_id", "store_id", "sale_date", "is_holiday", "holiday_name")


@query
def holiday_flag(t: Tables) -> DataFrame:
    return enrich.holiday_flag(_series_daily(t).select("agg_date", *SERIES, "total_quantity"), t.holidays(), "agg_date")


@query
def calendar_dim(t: Tables) -> DataFrame:
    return t.calendar()


@query
def calendar_contiguity(t: Tables) -> DataFrame:
    return quality.calendar_contiguity(t.calendar())


def _pos_products(t: Tables) -> DataFrame:
    """A product dimension that does not know the PROMO products."""
    return t.products().filter("category <> 'PROMO'").select(
        F.col("product_id").cast("string").alias("product_id"), (F.col("product_id") + 1).alias("product_key"),
        F.col("unit_price").alias("cost_price"))  # the list price stands for the cost


@query
def fact_load(t: Tables) -> DataFrame:
    stores = t.stores().select(F.col("store_id").cast("string").alias("store_id"), (F.col("store_id") + 1).alias("store_key"))
    return star.fact_rows(t.raw_pos(), _pos_products(t), stores, t.calendar(), batch_id="first").drop("load_timestamp")


@query
def fact_load_unmatched(t: Tables) -> DataFrame:
    return star.unmatched(t.raw_pos(), _pos_products(t), "product_id")


@query
def dim_product_upsert(t: Tables) -> DataFrame:
    """A dimension of the small and medium products, upserted from the sales of all of them."""
    known = t.products().filter("category in ('SMALL', 'MEDIUM')").select(
        F.col("product_id").cast("string").alias("product_id"), F.lit("old").alias("product_name"),
        "category", "brand", F.lit(0).cast("double").alias("unit_price"))
    dim = numbered_after(known, 0, ["product_id"], "product_key")
    return star.upsert_products(dim, t.raw_pos(), ["transaction_date", "transaction_id"])


@query
def dim_store_upsert(t: Tables) -> DataFrame:
    """Known stores keep their region and key; unknown ones are added behind them."""
    stores = t.stores().withColumn("store_id", F.col("store_id").cast("string"))
    dim = numbered_after(
        stores.filter("region <> 'ASIA'").select(
            "store_id", F.lit("old").alias("store_name"), F.lit("old").alias("city"), "state", F.lit("old").alias("region")),
        0, ["store_id"], "store_key")
    seen = t.raw_pos().select("store_id", "transaction_date").join(stores, "store_id")
    return star.upsert_stores(dim, seen, ["transaction_date"])


def _last_prices(t: Tables, days: int) -> DataFrame:
    """Highest line amount per product over the days before the as-of date: new prices."""
    recent = t.sales().filter(F.col("sale_date") >= F.date_sub(F.lit(AS_OF).cast("date"), days))
    return recent.groupBy("product_id").agg(money(dollars(F.max("gross_cents"))).alias("unit_price"))


@query
def merge_upsert(t: Tables) -> DataFrame:
    """Products with new prices for those sold lately, and as many relaunched under new ids."""
    prices = _last_prices(t, 30)
    relaunched = prices.withColumn("product_id", F.col("product_id") + 1_000_000_000)
    incoming = prices.unionByName(relaunched).withColumn("product_name", F.lit(None).cast("string"))
    target = t.products().select("product_id", "product_name", "brand", "unit_price")
    return merge.merge_upsert(target, incoming, ["product_id"], ["unit_price"])


@query
def insert_ignore(t: Tables) -> DataFrame:
    """Orders the target, which ends at the split day, does not hold yet."""
    orders = t.raw("orders").select(F.col("o_orderkey").alias("transaction_id"),
                                    F.col("o_orderdate").cast("date").alias("sale_date"), money("o_totalprice").alias("total"))
    return merge.insert_ignore(orders.filter(F.col("sale_date") < F.lit(SPLIT_DAY).cast("date")), orders, ["transaction_id"])


def _scd2(t: Tables) -> DataFrame:
    dim = t.products().select(
        "product_id", "category", "unit_price", F.lit(FIRST_DAY).cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"), F.lit(True).alias("is_current_record"))
    half_way = t.sales().filter(F.col("sale_date") < F.lit(SPLIT_DAY).cast("date")).groupBy("product_id").agg(
        money(dollars(F.max("gross_cents"))).alias("unit_price"))
    first = merge.scd2_merge(dim, half_way, "product_id", ["unit_price"], SPLIT_DAY)
    return merge.scd2_merge(first, _last_prices(t, 60), "product_id", ["unit_price"], "2001-07-01")


@query
def scd2_dim(t: Tables) -> DataFrame:
    return _scd2(t)


@query
def point_in_time_price(t: Tables) -> DataFrame:
    """Sales valued at the list price of their day, by category and year."""
    priced = merge.as_of_version(t.sales(), _scd2(t), "product_id", "sale_date")
    return priced.groupBy("category", F.year("sale_date").alias("year")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("quantity_sold") * F.col("unit_price")).alias("list_value"))


# -- events ---------------------------------------------------------------------

def _timed(events: DataFrame) -> DataFrame:
    return events.withColumnRenamed("ts", "event_timestamp")


@query
def clean_events(t: Tables) -> DataFrame:
    return clean.clean_events(_timed(t.events()))


@query
def event_product_enrich(t: Tables) -> DataFrame:
    products = t.products().withColumn("product_id", F.col("product_id").cast("string"))
    return enrich.with_product(t.events().select("event_id", "product_id", "price"), products)


@query
def session_metrics(t: Tables) -> DataFrame:
    return enrich.with_session_metrics(t.events().select("event_id", "session_id", "event_type"))


@query
def event_reject_reasons(t: Tables) -> DataFrame:
    checked = ingest.validated(t.as_json(t.events()))
    return checked.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome")).agg(F.count(F.lit(1)).alias("events"))


def _land_events(t: Tables, root: str) -> tuple[str, str]:
    """Events as day-partitioned JSON lines; the first and the last day."""
    lines = files.with_day_columns(t.events().withColumn("_day", F.col("ts").cast("date")), "_day")
    (lines.select(
        "event_id", "event_type", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        "session_id", "user_id", "product_id", F.col("price").cast("string").alias("price"),
        "year", "month", "day", F.lit("00").alias("hour"), F.lit("landed").alias("batch"))
     .hint("rebalance", "year", "month", "day")
     .write.partitionBy("year", "month", "day", "hour", "batch").json(f"{root}/raw/ecommerce"))
    # Two dates.
    first, last = t.events().agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    return str(first), str(last)


@query
def raw_event_files(t: Tables) -> DataFrame:
    """Events landed as day-partitioned JSON lines and read back from there."""
    root = run_dir(t.spark, "raw-events")
    flat = ingest.normalised(files.raw_events(t.spark, root, *_land_events(t, root)))
    return flat.select("event_id", "event_type", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
                       "session_id", "user_id", "product_id", "price")


@query
def events_batch(t: Tables) -> DataFrame:
    """The batch job over all days of landed events, with the product dimension of the warehouse."""
    root = run_dir(t.spark, "events-batch")
    layout = batch.Layout(root, f"{root}/warehouse")
    first, last = _land_events(t, root)
    t.products().withColumn("product_id", F.col("product_id").cast("string")).write.parquet(layout.table("dim_product"))
    batch.run_events(t.spark, layout, first, last)
    return t.spark.read.parquet(f"{root}/processed/ecommerce_events").select(
        "event_id", "event_type", "product_id", "dim_category", "list_price", "is_purchase", "session_event_count", "session_has_purchase")


@query
def raw_pos_files(t: Tables) -> DataFrame:
    """Sales lines landed as day-partitioned CSV in the files' order, and read back from there."""
    root = run_dir(t.spark, "raw-pos")
    lines = t.raw_pos()
    missing = {f.name: F.lit(None).cast(f.dataType) for f in RAW_POS if f.name not in lines.columns}
    dated = files.with_day_columns(lines.withColumns(missing).select(RAW_POS.fieldNames()), "transaction_date")
    (dated.hint("rebalance", "year", "month", "day").write.option("header", True)
     .partitionBy("year", "month", "day").csv(f"{root}/raw/pos"))
    # Two dates.
    first, last = lines.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    return files.raw_pos(t.spark, root, first, last).select(lines.columns)


def _delivered(rows: DataFrame, day: str, key: str) -> DataFrame:
    """Rows with a day of delivery: that of the row, but the day after for about a tenth of them."""
    late = (F.pmod(F.xxhash64(key), F.lit(10)) == 0).cast("int")
    return rows.withColumn("source_day", F.date_add(F.to_date(day), late))


@query
def processed_sales_lake(t: Tables) -> DataFrame:
    """Cleaned sales written in two loads, the second with late lines of days the first one wrote."""
    root = run_dir(t.spark, "sales-lake")
    cleaned = _delivered(clean.clean_pos(t.raw_pos()), "transaction_date", "transaction_id")
    sold = clean.sales_projection(cleaned, "source_day")
    for load in (0, 1):
        lake.write_sales(sold.filter(F.dayofyear("source_day") % 2 == load), root)
    return t.spark.read.parquet(f"{root}/processed/pos_fact").groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity_sold").alias("units"), F.sum("net_revenue").alias("net_revenue"))


@query
def processed_events_lake(t: Tables) -> DataFrame:
    """Cleaned events written in two loads by day of delivery and type, and read back."""
    root = run_dir(t.spark, "events-lake")
    cleaned = _delivered(clean.clean_events(_timed(t.events())), "event_timestamp", "event_id")
    for load in (0, 1):
        lake.write_events(cleaned.filter(F.dayofyear("source_day") % 2 == load), root)
    back = t.spark.read.parquet(f"{root}/processed/ecommerce_events")
    day = F.to_date("event_timestamp")
    return back.groupBy(F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("price").alias("total_price"))


# -- quality --------------------------------------------------------------------

# Four of the five order priorities count as accepted payment methods.
ACCEPTED = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@query
def dq_suite(t: Tables) -> DataFrame:
    return quality.pos_suite(t.raw_pos(), payment_methods=ACCEPTED).drop("details")


@query
def dq_report(t: Tables) -> DataFrame:
    return quality.report(quality.pos_suite(t.raw_pos(), payment_methods=ACCEPTED))


def _suite_log(t: Tables) -> DataFrame:
    """The suite's results as logged."""
    root = run_dir(t.spark, "check-log")
    lake.append_check_log(quality.pos_suite(t.raw_pos(), payment_methods=ACCEPTED), root, "run-1", "suite")
    return t.spark.read.parquet(f"{root}/dq_check_log")


@query
def dq_open_issues(t: Tables) -> DataFrame:
    """Logged results that did not pass."""
    return quality.open_issues(_suite_log(t)).select("check_name", "status", "pass_rate")


@query
def dq_todays_report(t: Tables) -> DataFrame:
    """What the log says of the day it was written."""
    log = _suite_log(t)
    day = log.agg(F.max(F.to_date("run_timestamp"))).first()[0]
    return quality.todays_report(log, str(day)).drop("run_timestamp")


@query
def dq_ref_integrity(t: Tables) -> DataFrame:
    known = t.products().filter("category <> 'PROMO'")
    counts = quality.referential_integrity(t.sales(dated=False), "product_id", known, "product_id")
    return quality.graded(counts, "fact_sales").drop("details")


@query
def dq_preload_gate(t: Tables) -> DataFrame:
    return quality.preload_gate(t.raw_pos())


@query
def dq_preload_gate_by_day(t: Tables) -> DataFrame:
    return quality.preload_gate_by_day(t.raw_pos(), "transaction_date")


@query
def dq_postload(t: Tables) -> DataFrame:
    return quality.post_load(t.sales(), t.products().filter("category <> 'PROMO'"), "2001-07-31")


@query
def dq_dims(t: Tables) -> DataFrame:
    return quality.dim_checks(t.products(), t.stores(), t.calendar(), 2000)


@query
def dq_gap_days(t: Tables) -> DataFrame:
    return quality.missing_days(_series_daily(t), FIRST_DAY, LAST_DAY)


@query
def dq_coverage(t: Tables) -> DataFrame:
    return quality.coverage(_series_daily(t), "2001-08-10")


# -- forecasts ------------------------------------------------------------------

def _demand_series(t: Tables) -> DataFrame:
    return forecast.series_from_daily(t.sales(), day="sale_date", value="quantity_sold")


@query
def forecast_dense_series(t: Tables) -> DataFrame:
    """Daily units per category with a row for every day, as the forecasts read them if asked to."""
    bought = t.sales().filter("quantity_sold > 45")
    return forecast.series_from_daily(bought.join(t.products().select("product_id", "category"), "product_id"), ["category"], "sale_date",
                                      "quantity_sold", densify=True)


@query
def forecast_ma(t: Tables) -> DataFrame:
    return forecast.forecast(_demand_series(t), forecast.moving_average(), horizon=HORIZON)


@query
def forecast_linear(t: Tables) -> DataFrame:
    return forecast.forecast(_demand_series(t), forecast.linear_trend(), horizon=HORIZON)


@query
def forecast_seasonal(t: Tables) -> DataFrame:
    return forecast.forecast(_demand_series(t), forecast.seasonal_naive(), horizon=HORIZON)


@query
def forecast_ensemble(t: Tables) -> DataFrame:
    return forecast.ensemble(_demand_series(t), horizon=HORIZON).drop("history_avg")


@query
def forecast_summary(t: Tables) -> DataFrame:
    return forecast.forecast_summary(forecast.ensemble(_demand_series(t), horizon=30))


# -- run log --------------------------------------------------------------------

@query
def table_counts(t: Tables) -> DataFrame:
    return runlog.table_counts({
        "dim_time": t.calendar(), "dim_product": t.products(), "dim_store": t.stores(),
        "fact_sales": t.raw("lineitem"), "agg_daily_demand": _daily(t).select("agg_date"), "stream_events": t.raw("events")})


@query
def run_metrics(t: Tables) -> DataFrame:
    """Row counters gathered by the write of the cleaned sales itself."""
    root = run_dir(t.spark, "run-metrics")
    run = runlog.RunRecord("pos_etl", "run-1")
    raw = run.observed(t.raw_pos(), rows_in=F.count(F.lit(1)), missing_names=F.count_if(F.col("product_name").isNull()))
    cleaned = run.observed(clean.clean_pos(raw), rows_out=F.count(F.lit(1)), net_revenue=F.sum("net_revenue").cast("double"))
    cleaned.write.format("noop").mode("overwrite").save()
    run.finish(t.spark, root)
    logged = t.spark.read.parquet(root)
    return logged.select("pipeline", "run_id", "status", F.explode("metrics").alias("metric", "value")).filter("metric <> 'elapsed_sec'")


ALERT_RULES = [("HighValue", "value", 400.0, 0, "critical"), ("SustainedValue", "value", 15.0, 7200, "warning")]


@query
def metric_alerts(t: Tables) -> DataFrame:
    samples = t.raw("events").select(F.col("event_type").alias("pipeline"), F.lit("value").alias("metric"), "ts", "value")
    return runlog.alerts(samples, ALERT_RULES, interval_seconds=3600)


# -- streams --------------------------------------------------------------------

def _drain(t: Tables, events: DataFrame | None = None) -> tuple[ingest.EventSink, str]:
    """Run the ingestion over the events table, or a stream of it, until it is drained."""
    root = run_dir(t.spark, "ingest")
    sink = ingest.EventSink(f"{root}/events", f"{root}/lake", f"{root}/quarantine")
    running = ingest.start_ingest(t.as_json(t.event_stream() if events is None else events), sink, f"{root}/checkpoint", every=None)
    running.awaitTermination()
    return sink, root


@query
def stream_clean_events(t: Tables) -> DataFrame:
    sink, _ = _drain(t)
    return t.spark.read.parquet(sink.table).select(
        "event_id", "event_type", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "session_id",
        "user_id", "product_id", "price", "quantity", "device", "state")


@query
def stream_counters(t: Tables) -> DataFrame:
    """What the listener wrote down of every batch of the ingestion, in several batches."""
    root = run_dir(t.spark, "counters")
    log = progress.ProgressLog(t.spark, f"{root}/progress")
    t.spark.streams.addListener(log)
    try:
        sink = ingest.EventSink(f"{root}/events", f"{root}/lake", f"{root}/quarantine")
        progress.finished(ingest.start_ingest(t.as_json(_out_of_order(t)), sink, f"{root}/checkpoint", every=None))
    finally:
        t.spark.streams.removeListener(log)
    return progress.counters(t.spark, f"{root}/progress").select("metric", "value")


def _in_files(t: Tables, part_bytes: int = 1_500_000) -> DataFrame:
    """The events in as many parts as the stored table needs at ``part_bytes`` each, for files that fill micro-batches evenly.

    Events of one id share a file, so which of them counts does not depend on where a micro-batch ends.
    """
    key = F.coalesce("event_id", F.col("ts").cast("string"))
    return t.events().repartition(parts_of(t.raw("events"), part_bytes), key)


@query
def stream_restarted(t: Tables) -> DataFrame:
    """Events of an ingestion that ended, found more files when it was started again, and then everything once more."""
    root = run_dir(t.spark, "restarted")
    sink, events = ingest.EventSink(f"{root}/events", f"{root}/lake", f"{root}/quarantine"), t.as_json(_in_files(t))
    part = F.pmod(F.xxhash64("value"), F.lit(2))
    for delivered in (part == 0, part == 1, F.lit(True)):
        events.filter(delivered).write.mode("append").text(f"{root}/in")
        source = streams.json_line_events(t.spark, f"{root}/in", max_bytes=BATCH_BYTES)
        ingest.start_ingest(source, sink, f"{root}/checkpoint", every=None).awaitTermination()
    return t.spark.read.parquet(sink.table).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"), F.sum("price").alias("total_price"))


@query
def stream_quarantine(t: Tables) -> DataFrame:
    sink, _ = _drain(t)
    return t.spark.read.parquet(sink.quarantine).select("event_id", "reject_reason")


@query
def stream_raw_lake(t: Tables) -> DataFrame:
    """What several batches of the stream left in the raw lake, their hours packed, read as raw event files."""
    sink, _ = _drain(t, _out_of_order(t))
    # Two times.
    first, last = t.spark.read.parquet(sink.table).agg(F.min("load_timestamp"), F.max("load_timestamp")).first()
    packing.pack_hours(t.spark, sink.lake, last + dt.timedelta(hours=1, minutes=60))
    back = files.raw_events(t.spark, sink.lake, first.date().isoformat(), last.date().isoformat())
    return back.groupBy("event_type", "state").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("price").cast("decimal(10,2)")).alias("total_price"))


def _stream_times(t: Tables) -> DataFrame:
    """The event stream with times as instants, which event-time operators need; the tables' clock is UTC."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
    return t.event_stream().withColumn("ts", local.cast("timestamp"))


def _utc(instant: str):
    """An instant back on the tables' clock."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(instant).cast("timestamp_ntz"))


def _out_of_order(t: Tables, batches: int = 3, part_bytes: int = 1_500_000) -> DataFrame:
    """The event stream in several micro-batches that each hold events of all times.

    A micro-batch comes in as many parts as the stored table needs at ``part_bytes`` each, since a task that reads a part
    holds its events as JSON, some forty times as wide; files alone would be packed into fewer tasks as they are read.
    """
    path = run_dir(t.spark, "out-of-order")
    parts = max(1, -(-known_bytes(t.raw("events")) // (batches * part_bytes)))
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts"))
    events = t.events().withColumn("ts", local.cast("timestamp"))
    events.repartition(batches * parts, F.xxhash64("event_id")).write.parquet(path)
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", parts).parquet(path)
    return stream.repartition(parts) if parts > 1 else stream


@query
def stream_tumbling_demand(t: Tables) -> DataFrame:
    """Windows of events that come in any order, kept without state in the stream."""
    root = run_dir(t.spark, "tumbling")
    signals.start_window_totals(
        _out_of_order(t), "ts", ["event_type"], "price", "6 hours", f"{root}/t", f"{root}/c", every=None).awaitTermination()
    return t.spark.read.parquet(f"{root}/t").select(
        _utc("window_start").alias("window_start"), "event_type", "events", "total_value")


@query
def stream_sessions(t: Tables) -> DataFrame:
    """All sessions of users whose events come in any order."""
    root = run_dir(t.spark, "sessions")
    signals.start_sessions(_out_of_order(t), "ts", "user_id", "6 hours", f"{root}/t", f"{root}/c", None).awaitTermination()
    return signals.with_duration(t.spark.read.parquet(f"{root}/t")).select(
        "user_id", _utc("session_start").alias("session_start"), "events", "has_purchase", "duration_us")


@query
def stream_deduplicated(t: Tables) -> DataFrame:
    """The event stream delivered twice, each event kept once."""
    root = run_dir(t.spark, "dedup")
    twice = _stream_times(t).unionByName(_stream_times(t))
    signals.start_append(signals.deduplicated(twice, "ts", delay="31 days"), f"{root}/t", f"{root}/c", None).awaitTermination()
    return t.spark.read.parquet(f"{root}/t").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("distinct_events"))


@query
def batch_speed_view(t: Tables) -> DataFrame:
    """Daily events from a batch up to a day, completed by the stream's daily windows."""
    daily = t.events().groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("price").alias("total_value"))
    root = run_dir(t.spark, "speed")
    signals.start_window_totals(
        _stream_times(t), "ts", ["event_type"], "price", "1 day", f"{root}/t", f"{root}/c", every=None).awaitTermination()
    speed = t.spark.read.parquet(f"{root}/t").select(_utc("window_start").cast("date").alias("day"), "event_type", "events", "total_value")
    return signals.serving_view(daily.filter(F.col("day") < F.lit("2024-01-20").cast("date")), speed, "day")
