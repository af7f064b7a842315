"""A third of all rows under one key: joins are split, groups are combined early."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillmark.operators import enrich, merge
from tillmark.operators.analytics import customer_cohorts

N = 300_000
SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
         "spark.sql.shuffle.partitions": "16"}


@pytest.fixture
def sized(spark):
    """Thresholds that make the test tables count as large."""
    old = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def hot(column, spread=5000):
    return F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % spread).cast("string")).alias(column)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_session_is_split(sized):
    events = sized.range(0, N, 1, 6).select(F.col("id").cast("string").alias("event_id"), hot("session_id"),
                                            F.lit("purchase").alias("event_type"))
    metrics = enrich.with_session_metrics(events)
    assert "skew=true" in final_plan(metrics)
    counts = metrics.filter("session_id = 'hot'").agg(F.min("session_event_count"), F.count("*")).first()
    assert tuple(counts) == (N // 3, N // 3)


def test_hot_product_is_split_in_a_price_lookup(sized, tmp_path):
    sales = sized.range(0, N, 1, 6).select(hot("product_id"), F.lit("2023-05-01").cast("date").alias("d"), F.col("id").alias("n"))
    sales.select("product_id").distinct().select(
        "product_id", F.lit(1.0).alias("price"), F.lit("2023-01-01").cast("date").alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to")).write.parquet(str(tmp_path / "dim"))
    priced = merge.as_of_version(sales, sized.read.parquet(str(tmp_path / "dim")), "product_id", "d")
    assert "skew=true" in final_plan(priced)
    assert priced.count() == N


def test_hot_customer_is_one_row_a_month(sized):
    sales = sized.range(0, N, 1, 6).select(hot("customer_id"), F.expr("date_add(date'2022-01-01', cast(id % 700 as int))").alias("sale_date"))
    found = customer_cohorts(sales)
    assert found.filter("cohort = '2022-01'").agg(F.max("active_customers")).first()[0] > 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The distinct is taken on the map side: an aggregate lies under the first exchange.
    assert "HashAggregate(keys=[customer_id" in plan[plan.rindex("hashpartitioning(customer_id"):]


def test_known_ids_are_found_without_shuffling_the_target(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "target"))
    spark.range(990, 1010).write.parquet(str(tmp_path / "source"))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "source"))
    new = merge.insert_ignore(target, source, ["id"], as_small_as=source)
    assert sorted(r[0] for r in new.collect()) == list(range(1000, 1010))
    assert "Exchange hashpartitioning" not in new._jdf.queryExecution().executedPlan().toString()
