from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillmark.operators import analytics, star
from tillmark.plans import batch
from tillmark.sources import files


def raw_day(spark, day, n=150, prefix="T", returns=0):
    """Sales lines of a day over 3 products and 2 stores."""
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit(f"{prefix}{day}-"), i).alias("transaction_id"), F.lit(day).alias("transaction_date"),
        F.lit("10:00:00").alias("transaction_time"), F.concat(F.lit("S"), i % 2).alias("store_id"), F.lit("Store").alias("store_name"),
        F.lit("City").alias("city"), F.lit("CA").alias("state"), F.lit("West").alias("region"),
        F.concat(F.lit("P"), i % 3).alias("product_id"), F.lit("Name").alias("product_name"), F.lit("Toys").alias("category"),
        F.lit("Brand").alias("brand"), F.when(i < returns, -1).otherwise(2).alias("quantity"), F.lit(10.0).alias("unit_price"),
        F.lit(0.1).alias("discount"), F.lit(0.0).alias("total_amount"), F.lit("Cash").alias("payment_method"), F.lit("C1").alias("customer_id"))


@pytest.fixture
def layout(tmp_path):
    return batch.Layout(str(tmp_path / "lake"), str(tmp_path / "warehouse"))


def land(spark, layout, day, **kind):
    files.land_sales(raw_day(spark, day, **kind), layout.lake, day)


def test_days_load_once_and_add_up(spark, layout):
    weather = spark.sql("select date'2023-01-02' weather_date, 'CA' weather_state, 61D temp_high_f, 0D precipitation_in, 'Sun' weather_condition")
    holidays = spark.sql("select date'2023-01-02' holiday_date, 'Bank Holiday' holiday_name")
    read = lambda name: spark.read.parquet(layout.table(name))
    more = {"weather": weather, "holidays": holidays}

    land(spark, layout, "2023-01-01")
    land(spark, layout, "2023-01-02")
    checks = batch.run_batch(spark, layout, "2023-01-01", run_id="r1", **more)
    assert {r["status"] for r in checks.collect()} == {"PASS"}
    batch.run_batch(spark, layout, "2023-01-02", run_id="r2", **more)
    batch.run_batch(spark, layout, "2023-01-02", run_id="r2-again", **more)

    assert read("fact_sales").count() == 300
    facts = star.sales_rows(read("fact_sales"), read("dim_product"), read("dim_store"))
    assert analytics.store_performance(facts, read("dim_store")).count() == 2
    assert analytics.discount_effectiveness(facts, read("dim_product")).count() == 1
    assert (read("dim_product").count(), read("dim_store").count(), read("dim_time").count()) == (3, 2, 365)
    daily = read("agg_daily_demand")
    assert daily.count() == 12
    assert daily.agg(F.sum("total_quantity"), F.sum("total_revenue").cast("double"), F.sum("total_orders")).first()[:] == (600, 5400.0, 300)
    monday = daily.filter("agg_date = '2023-01-02'").first()
    assert monday["is_holiday"] and monday["temp_high_f"] == 61.0 and monday["category"] == "Toys" and monday["region"] == "West"
    weekly = read("agg_weekly_demand").filter("week_start = '2023-01-02'").agg(F.sum("total_quantity"), F.sum("prev_week_qty")).first()
    assert tuple(weekly) == (300, 300)

    path = batch.export_features(spark, layout, "2023-01-03", 30)
    exported = spark.read.option("header", True).csv(path)
    # The nightly job has exported every load under its day.
    assert {(str(r["dt"]), r["count"]) for r in exported.groupBy("dt").count().collect()} == {
        ("2023-01-01", 6), ("2023-01-02", 12), ("2023-01-03", 12)}
    ranks = read("agg_product_rank")
    fresh = analytics.monthly_ranks(facts)
    assert sorted(map(tuple, ranks.select(fresh.columns).collect())) == sorted(map(tuple, fresh.collect())) and ranks.count() == 3
    runs = {r["run_id"]: r for r in read("run_metrics").collect()}
    assert runs["r1"]["metrics"]["rows_read"] == 150 and runs["r1"]["metrics"]["rows_clean"] == 150
    assert runs["r2"]["metrics"]["rows_fact_sales"] == 300 and runs["r2"]["metrics"]["rows_agg_daily_demand"] == 12
    assert read("dq_check_log").filter("pipeline_run_id = 'r1' and status = 'PASS'").count() == 7


def test_backfill_goes_on_past_a_bad_day(spark, layout):
    land(spark, layout, "2023-01-01")
    land(spark, layout, "2023-01-02", returns=30)
    land(spark, layout, "2023-01-04", n=300)
    batch.run_batch(spark, layout, "2023-01-01", "2023-01-05", run_id="b1")
    days = {str(r["sale_date"]): r["count"] for r in spark.read.parquet(layout.table("fact_sales")).groupBy("sale_date").count().collect()}
    assert days == {"2023-01-01": 150, "2023-01-04": 300}
    failed = spark.read.parquet(layout.table("dq_check_log")).filter("status = 'FAIL'").collect()
    assert [(r["check_name"], r["details"]) for r in failed] == [("quantity_positive", "2023-01-02")]


def test_closed_gate_stops_the_run(spark, layout):
    land(spark, layout, "2023-01-01", n=50)
    with pytest.raises(batch.GateClosed):
        batch.run_batch(spark, layout, "2023-01-01", run_id="x")
    run = spark.read.parquet(layout.table("run_metrics")).first()
    assert run["status"] == "failed" and "GateClosed" in run["errors"][0]


def test_calendar_is_widened(spark, layout):
    assert batch.ensure_calendar(spark, layout, "2023-05-01", "2023-05-02", None).count() == 365
    assert batch.ensure_calendar(spark, layout, "2024-05-01", "2024-05-02", None).count() == 731
    assert batch.ensure_calendar(spark, layout, "2023-05-01", "2023-05-02", None).agg(F.max("full_date")).first()[0] == dt.date(2024, 12, 31)


def test_late_lines_reach_the_lake_and_the_aggregates(spark, layout):
    files.land_sales(raw_day(spark, "2023-01-01"), layout.lake, "2023-01-01")
    late = raw_day(spark, "2023-01-01", n=1, prefix="late")
    files.land_sales(raw_day(spark, "2023-01-02").unionByName(late), layout.lake, "2023-01-02")
    batch.run_batch(spark, layout, "2023-01-01", run_id="1")
    batch.run_batch(spark, layout, "2023-01-02", run_id="2")
    read = lambda name: spark.read.parquet(layout.table(name))
    orders = {str(r[0]): r[1] for r in read("agg_daily_demand").groupBy("agg_date").agg(F.sum("total_orders")).collect()}
    assert orders == {"2023-01-01": 151, "2023-01-02": 150} and read("fact_sales").count() == 301
    assert spark.read.parquet(f"{layout.lake}/processed/pos_fact").filter("transaction_date = '2023-01-01'").count() == 151


def test_a_range_equals_its_days_one_by_one(spark, tmp_path):
    """Changing prices, a transaction delivered twice, and late lines."""
    tables = {}
    for name, ranges in (("days", ["01", "02", "03"]), ("range", [("01", "03")])):
        layout = batch.Layout(str(tmp_path / name / "lake"), str(tmp_path / name / "warehouse"))
        for n in (1, 2, 3):
            lines = raw_day(spark, f"2023-01-0{n}").withColumn("unit_price", F.lit(10.0 + n)).withColumn("city", F.lit(f"City {n}"))
            if n > 1:
                again = raw_day(spark, f"2023-01-0{n - 1}", n=5).withColumn("unit_price", F.lit(77.0))
                lines = lines.unionByName(again).unionByName(raw_day(spark, f"2023-01-0{n - 1}", n=2, prefix="late"))
            files.land_sales(lines, layout.lake, f"2023-01-0{n}")
        for days in ranges:
            first, last = (days, days) if isinstance(days, str) else days
            batch.run_batch(spark, layout, f"2023-01-{first}", f"2023-01-{last}", run_id=f"run-{first}")
        read = lambda path, drop=(): sorted((tuple(r) for r in spark.read.parquet(path).drop(*drop).collect()), key=repr)
        tables[name] = {t: read(layout.table(t), ["batch_id", "load_timestamp"]) for t in (
            "dim_product", "dim_store", "fact_sales", "agg_daily_demand", "agg_weekly_demand")}
        tables[name]["lake"] = read(f"{layout.lake}/processed/pos_fact")
    assert tables["days"] == tables["range"]


def test_cost_and_profit_of_the_facts(spark, layout):
    """Costs of two of three products; the views of the written facts have a margin where there is a cost."""
    land(spark, layout, "2023-01-01")
    land(spark, layout, "2023-01-02")
    costs = spark.createDataFrame([("P0", 4.0), ("P1", 6.0), ("unknown", 1.0)], "product_id string, cost_price double")
    batch.run_batch(spark, layout, "2023-01-01", run_id="1", costs=costs, export_days=None)
    batch.run_batch(spark, layout, "2023-01-02", run_id="2", export_days=None)  # costs stay
    read = lambda name: spark.read.parquet(layout.table(name))
    facts = read("fact_sales").join(read("dim_product").select("product_key", "product_id"), "product_key")
    found = {r[0]: (r[1] and float(r[1]), r[2] and float(r[2])) for r in facts.groupBy("product_id").agg(
        F.max("cost_of_goods"), F.min("gross_profit")).collect()}
    assert found == {"P0": (8.0, 10.0), "P1": (12.0, 6.0), "P2": (None, None)}
    sales = star.sales_rows(read("fact_sales"), read("dim_product"), read("dim_store"))
    margins = analytics.store_performance(sales, read("dim_store")).collect()
    assert all(float(r["gross_profit"]) > 0 for r in margins) and read("dim_product").count() == 3
    assert not list((p for p in [layout.lake + "/processed/ml_ready"] if batch.sinks.path_exists(spark, p)))


def test_the_gate_logs_its_thresholds(spark, layout):
    land(spark, layout, "2023-01-01")
    batch.run_batch(spark, layout, "2023-01-01", run_id="1")
    logged = spark.read.parquet(layout.table("dq_check_log")).filter("check_type = 'pre_load'").collect()
    assert {r["check_name"]: r["threshold"] for r in logged} == {
        "row_count_ok": 0.0, "txn_id_no_nulls": 0.0, "quantity_positive": 0.01, "duplicate_txns": 0.02}


@pytest.mark.parametrize("with_products", [True, False])
def test_events_of_a_day(spark, layout, with_products):
    events = [("e1", "purchase", "2023-01-01T10:00:00Z", "s1", "P0", "9.5"), ("e1", "purchase", "2023-01-01T11:00:00Z", "s1", "P0", "9.5"),
              ("e2", "product_view", "2023-01-01T10:05:00Z", "s1", "P9", None), ("e3", "product_view", "2023-01-01T10:05:00Z", "s2", "P0", "-1")]
    frame = spark.createDataFrame(events, "event_id string, event_type string, event_timestamp string, session_id string, product_id string, price string")
    files.land_events(frame, layout.lake, "2023-01-01")
    if with_products:
        land(spark, layout, "2023-01-01")
        batch.run_batch(spark, layout, "2023-01-01", run_id="1")
    for _ in range(2):
        batch.run_events(spark, layout, "2023-01-01")
    found = {r["event_id"]: r for r in spark.read.parquet(f"{layout.lake}/processed/ecommerce_events").collect()}
    assert set(found) == {"e1", "e2"} and found["e1"]["session_event_count"] == 2 and found["e2"]["session_has_purchase"] == 1
    assert found["e1"]["dim_category"] == ("Toys" if with_products else None) and found["e2"]["list_price"] is None
