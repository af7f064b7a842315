from __future__ import annotations

import datetime as dt
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.functions.numbers import sample_std, squared
from tillmark.operators import analytics, dashboard, demand, features

SALES = ("sale_date date, product_id string, store_id string, transaction_id string, quantity_sold int, net_cents bigint, "
         "gross_cents bigint, discount_cents bigint, customer_id string, channel string")


def day(text):
    return dt.date.fromisoformat(text)


def sales(spark, *lines):
    """(date, product, store, transaction, units): 10 money units each, no discount."""
    return spark.createDataFrame(
        [(day(d), p, s, t, q, q * 1000, q * 1000, 0, "c", "store") for d, p, s, t, q in lines], SALES)


def test_daily_totals(spark):
    lines = sales(spark, ("2023-06-15", "P001", "S001", "t1", 10), ("2023-06-15", "P001", "S001", "t1", 20),
                  ("2023-06-15", "P002", "S001", "t2", 5))
    found = {r["product_id"]: r for r in demand.daily_demand(lines).collect()}
    assert found["P001"]["total_quantity"] == 30 and found["P001"]["total_orders"] == 1
    assert found["P001"]["avg_order_value"] == Decimal("300.00") and found["P002"]["discount_rate"] == Decimal("0.0000")


def test_weeks_follow_the_iso_year(spark):
    lines = sales(spark, ("2022-12-26", "P", "S", "a", 7), ("2023-01-01", "P", "S", "b", 7), ("2023-01-02", "P", "S", "c", 21))
    weeks = demand.with_week_over_week(demand.weekly_demand(lines)).orderBy("week_start").collect()
    assert [(r["year"], r["week_of_year"], r["total_quantity"]) for r in weeks] == [(2022, 52, 14), (2023, 1, 21)]
    assert weeks[0]["prev_week_qty"] is None
    assert (weeks[1]["prev_week_qty"], weeks[1]["wow_change_pct"]) == (14, Decimal("50.0000"))
    assert weeks[0]["avg_daily_qty"] == Decimal("2.00")


def test_week_over_week_across_a_gap(spark):
    weekly = demand.weekly_demand(sales(spark, ("2023-01-02", "P", "S", "a", 4), ("2023-01-16", "P", "S", "b", 6)))
    by_calendar = demand.with_week_over_week(weekly).orderBy("week_start").collect()[1]
    by_row = demand.with_week_over_week(weekly, mode="row").orderBy("week_start").collect()[1]
    assert by_calendar["prev_week_qty"] is None and by_calendar["wow_change_pct"] is None
    assert by_row["prev_week_qty"] == 4


def test_zero_previous_week_gives_no_change(spark):
    weekly = demand.weekly_demand(sales(spark, ("2023-01-02", "P", "S", "a", 0), ("2023-01-09", "P", "S", "b", 6)))
    assert demand.with_week_over_week(weekly).orderBy("week_start").collect()[1]["wow_change_pct"] is None


def test_lags_by_row_and_by_calendar(spark):
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(10) if i != 4]
    daily = spark.createDataFrame([(d, "P", "S", i + 1) for i, d in enumerate(days)],
                                  "agg_date date, product_id string, store_id string, total_quantity bigint")
    by_row = features.with_lag_features(daily).orderBy("agg_date").collect()
    by_day = features.with_lag_features(daily, mode="calendar").orderBy("agg_date").collect()
    assert by_row[8]["demand_lag_7d"] == 2 and by_day[8]["demand_lag_7d"] == 3
    assert by_row[0]["rolling_avg_7d"] is None and by_row[1]["rolling_std_7d"] is None
    assert by_row[8]["rolling_avg_7d"] == pytest.approx(5.0)
    assert by_day[8]["rolling_avg_7d"] == pytest.approx((3 + 4 + 5 + 6 + 7 + 8) / 6)
    assert by_row[8]["rolling_std_7d"] == pytest.approx(2.160246899469287)
    strict = features.with_lag_features(daily, min_periods=(3, 7), std=False).orderBy("agg_date").collect()
    assert [r["rolling_avg_7d"] is None for r in strict[:4]] == [True, True, True, False]


def test_densified_series_has_every_day(spark):
    daily = spark.createDataFrame([(day("2023-01-01"), "P", 3), (day("2023-01-04"), "P", 5)], "agg_date date, k string, q bigint")
    assert [r["q"] for r in features.densify(daily, ["k"], "q").orderBy("agg_date").collect()] == [3, 0, 0, 5]


def test_cohorts_do_not_wrap_after_a_year(spark):
    lines = sales(spark, ("2022-01-31", "P", "S", "a", 1), ("2022-02-01", "P", "S", "b", 1), ("2023-01-15", "P", "S", "c", 1))
    assert [tuple(r) for r in analytics.customer_cohorts(lines).collect()] == [
        ("2022-01", 0, 1), ("2022-01", 1, 1), ("2022-01", 12, 1)]


def test_abc_boundaries_belong_to_the_better_class(spark):
    lines = sales(spark, *[("2023-01-01", p, "S", p, q) for p, q in (("a", 80), ("b", 15), ("c", 5))])
    products = spark.createDataFrame([(p, p, "k") for p in "abcd"], "product_id string, product_name string, category string")
    assert [(r["product_id"], r["abc_class"]) for r in analytics.abc_classes(lines, products).collect()] == [
        ("a", "A"), ("b", "B"), ("c", "C")]


def test_scorecard_keeps_stores_without_a_prior_quarter(spark):
    lines = sales(spark, ("2023-05-01", "P", "old", "a", 2), ("2022-05-01", "P", "old", "b", 1), ("2023-06-30", "P", "new", "c", 1),
                  ("2023-07-01", "P", "old", "d", 9), ("2022-04-01", "P", "gone", "e", 1))
    stores = spark.createDataFrame([(s, s, "r") for s in ("old", "new", "gone")], "store_id string, store_name string, region string")
    found = {r["store_id"]: r for r in analytics.store_scorecard(lines, stores, "2023-06-15").collect()}
    assert set(found) == {"old", "new"}
    assert found["old"]["yoy_growth_pct"] == Decimal("100.00") and found["new"]["yoy_growth_pct"] is None


@pytest.mark.parametrize("as_of, first, after", [("2023-12-31", "2023-10-01", "2024-01-01"), ("2023-01-01", "2023-01-01", "2023-04-01"),
                                                 ("2023-09-30", "2023-07-01", "2023-10-01")])
def test_quarter_bounds(as_of, first, after):
    assert analytics._quarter(day(as_of)) == (day(first), day(after))


def test_demand_signals_ignore_flat_series(spark):
    history = [(day("2023-01-01") + dt.timedelta(days=i), "spike", "S", 10 + i % 2) for i in range(30)]
    history += [(d, "flat", "S", 10) for d, *_ in history] + [(day("2023-01-31"), "spike", "S", 90), (day("2023-01-31"), "flat", "S", 10)]
    daily = spark.createDataFrame(history, "agg_date date, product_id string, store_id string, total_quantity bigint")
    found = analytics.demand_signals(daily, "2023-02-01").collect()
    assert [(r["product_id"], r["demand_signal"], r["today_qty"]) for r in found] == [("spike", "EXTREME_SPIKE", 90)]
    without = analytics.demand_signals(daily, "2023-02-01", include_tested_day=False).first()
    assert without["z_score"] > found[0]["z_score"]


def test_slow_movers_put_never_sold_first(spark):
    lines = sales(spark, ("2023-01-01", "old", "S", "a", 1), ("2023-03-01", "new", "S", "b", 1))
    products = spark.createDataFrame([(p, p, "k", 1.0, p != "off") for p in ("old", "new", "never", "off")],
                                     "product_id string, product_name string, category string, unit_price double, is_active boolean")
    found = analytics.slow_movers(lines, products, "2023-03-02").collect()
    assert [(r["product_id"], r["days_since_last_sale"]) for r in found] == [("never", None), ("old", 60)]


def test_dashboard_slices_and_floor(spark):
    daily = spark.createDataFrame([(day("2023-01-01"), "k", "r", 2, Decimal("5.00"), 0)],
                                  "agg_date date, category string, region string, total_quantity bigint, total_revenue decimal(20,2), total_orders bigint")
    assert dashboard.kpi_totals(daily).first()["avg_order_value"] == Decimal("5.00")
    assert dashboard.slice_demand(daily, "2023-01-01", "2023-01-01", "k", "r").count() == 1
    assert dashboard.slice_demand(daily, "2023-01-02").count() == 0
    assert dashboard.slice_demand(daily, category="other").count() == 0


def test_feature_validation(spark):
    df = spark.createDataFrame([(1, None), (0, 2), (-3, 4)], "target_demand int, x int")
    assert {r["column_name"]: r["null_rate"] for r in features.null_rates(df).collect()} == {"x": Decimal("0.3333")}
    stats = features.target_stats(df).first()
    assert (stats["zeros"], stats["neg"], stats["min"], stats["mean"]) == (1, 1, -3, Decimal("-0.67"))
    assert not features.export_allowed(df) and features.export_allowed(df.filter(F.col("target_demand") >= 0))


@pytest.mark.parametrize("base", [0, 10 ** 8, 10 ** 9])
def test_spread_of_large_values_is_exact(spark, base):
    values = [base + n % 3 for n in range(30)]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    got = frame.agg(sample_std(F.count("v"), F.sum("v"), F.sum(squared("v")))).first()[0]
    assert got == pytest.approx(statistics.stdev(values), rel=1e-12)
