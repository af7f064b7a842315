from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillmark.functions import sketches
from tillmark.operators import demand, increments, merge

SALES = ("transaction_id long, line_number int, product_id long, store_id long, sale_date date, quantity_sold int, net_cents long, "
         "gross_cents long, discount_cents long")


def lines(spark, rng, n, first, last):
    days = [dt.date(2023, first, 1) + dt.timedelta(days=i) for i in range(31 * (last - first + 1))]
    return spark.createDataFrame([(i // 3, i % 3, rng.randint(0, 5), rng.randint(0, 3), rng.choice(days), rng.randint(1, 9), 90, 100, 10)
                                  for i in range(n)], SALES).persist()


def test_deltas_equal_a_full_computation(spark, tmp_path):
    """Lines that come in, are corrected, and are withdrawn for good, one load repeated."""
    rng = random.Random(1)
    path = str(tmp_path / "p")
    start = lines(spark, rng, 400, 1, 3)
    increments.apply_lines(spark, path, "s", 0, start)
    january = {f.stat().st_mtime_ns for f in (tmp_path / "p" / "month=2023-01-01").iterdir()}
    wrong = start.filter("sale_date >= '2023-03-01' and product_id < 3")
    right = wrong.filter("line_number < 2").withColumn("quantity_sold", F.col("quantity_sold") + 1)
    for _ in range(2):
        increments.apply_lines(spark, path, "s", 1, right, withdrawn=wrong)
    # Months without a change are not written again.
    assert {f.stat().st_mtime_ns for f in (tmp_path / "p" / "month=2023-01-01").iterdir()} == january
    now = start.exceptAll(wrong).unionAll(right)
    got = increments.daily_demand(spark.read.parquet(path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, demand.daily_demand(now).select(*got.columns).collect()))
    coarse = increments.daily_demand(spark.read.parquet(path), ["product_id"])
    assert sorted(map(tuple, coarse.collect())) == sorted(
        map(tuple, demand.daily_demand(now, ["product_id"]).select(*coarse.columns).collect()))
    everything = spark.read.parquet(path)
    increments.apply_lines(spark, path, "s", 2, now.limit(0), withdrawn=now)
    assert not list((tmp_path / "p").glob("month=*")) and everything is not None


def test_sketches_of_days_are_united(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 7919).alias("customer"))
    daily = sketches.with_sketch(rows.unionAll(rows), ["day"], "customer", "s")
    found = sketches.united(daily, [(F.col("day") % 2).alias("half")], "s", "n").collect()
    assert len(found) == 2 and all(abs(r.n - 7919) <= 7919 * sketches.error_bound() for r in found)
    nulls = sketches.with_sketch(rows.withColumn("customer", F.lit(None).cast("long")), ["day"], "customer", "s")
    assert {r.n for r in sketches.united(nulls, ["day"], "s", "n").collect()} == {0}


def test_a_key_with_ten_thousand_versions(spark):
    """Every version of a day is met by its facts only: the join makes no more rows than a month has days for each fact."""
    first = F.lit("1990-01-01").cast("date")
    dim = spark.range(10_000).select(F.lit(1).alias("id"), F.col("id").cast("int").alias("price"), F.date_add(first, F.col("id").cast("int")).alias("effective_from"),
                                     F.when(F.col("id") < 9_999, F.date_add(first, F.col("id").cast("int") + 1)).alias("effective_to"))
    facts = spark.range(20_000).select(F.lit(1).alias("id"), F.date_add(first, (F.col("id") % 10_100 - 50).cast("int")).alias("sold"), F.col("id").alias("n"))
    found = merge.as_of_version(facts, dim, "id", "sold")
    assert found.filter(F.col("price") != F.least(F.datediff("sold", first), F.lit(9_999))).isEmpty()
    assert found.count() == facts.filter(F.col("sold") >= first).count()
    assert merge.as_of_version(facts.limit(0), dim, "id", "sold").isEmpty()


def test_rows_that_cannot_be_merged_are_found_and_stop_the_merge(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "z"), (1, "b"), (None, "c"), (3, "x"), (3, "x")], "k int, v string")
    assert sorted((r.k or 0, r.v, r.reason) for r in merge.unfit_rows(source, ["k"]).collect()) == [
        (0, "c", "null_key"), (1, "b", "ambiguous_key"), (1, "z", "ambiguous_key")]
    for bad in (source, source.filter("k is null or k = 3"), source.filter("k = 1")):
        with pytest.raises(Exception, match="to merge"):
            merge.merge_upsert(target, bad, ["k"]).collect()
    fine = merge.merge_upsert(target, source.filter("k = 3"), ["k"])
    assert sorted(map(tuple, fine.collect())) == [(1, "a"), (2, "b"), (3, "x")]


def test_rollup_levels(spark):
    daily = spark.createDataFrame([(dt.date(2023, 1, d), r, c, d, 1.0) for d in (1, 2) for r in "ab" for c in "xy"],
                                  "agg_date date, region string, category string, total_quantity long, total_revenue double")
    found = {(r.region, r.category): (r.level, r.total_quantity, r.days) for r in demand.demand_rollup(daily).collect()}
    assert found == {**{(r, c): (0, 3, 2) for r in "ab" for c in "xy"}, ("a", None): (1, 6, 2), ("b", None): (1, 6, 2), (None, None): (3, 12, 2)}
