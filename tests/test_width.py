"""Tasks that stay small as tables grow."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillmark.operators import demand
from tillmark.plans import queries
from tillmark.plans.tables import Tables, schema_of
from tillmark.streaming import events as ingest

DAY = dt.datetime(2000, 1, 3)


def sold(spark, path):
    lines = [(o, p % 5, p % 3, p, 2.0, 10.0 * p, 0.05, 0.0, "N", "O", DAY) for o in range(200) for p in range(1, 4)]
    spark.createDataFrame(lines, schema_of("lineitem")).write.parquet(f"{path}/lineitem.parquet")
    orders = [(o, o % 9, "O", 1.0, DAY + dt.timedelta(days=o % 20), "1-URGENT") for o in range(200)]
    spark.createDataFrame(orders, schema_of("orders")).write.parquet(f"{path}/orders.parquet")


def test_sales_and_series_are_dealt_by_the_size_of_the_lines(spark, tmp_path, monkeypatch, rows):
    sold(spark, tmp_path)
    weekly = lambda: queries.weekly_demand_product_store(Tables(spark, str(tmp_path)))
    want = rows(weekly(), "week_start", *demand.SERIES, "total_quantity", "total_orders", "prev_week_qty")
    monkeypatch.setattr(Tables, "parts", lambda self: 7)
    assert "REPARTITION" not in weekly()._jdf.queryExecution().executedPlan().toString().split("Join")[-1]  # orders are broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = weekly()._jdf.queryExecution().executedPlan().toString()
        assert "transaction_id" in plan and sum(", 7), REPARTITION_BY_NUM" in line for line in plan.splitlines()) == 3
        assert rows(weekly(), "week_start", *demand.SERIES, "total_quantity", "total_orders", "prev_week_qty") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_micro_batch_comes_in_several_parts(spark, tmp_path):
    events = [(None if i % 10 == 0 else i % 700, DAY + dt.timedelta(minutes=i), i % 9, "view", 1.0, '{"k": "3"}') for i in range(3000)]
    spark.createDataFrame(events, schema_of("events")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    t, seen = Tables(spark, str(tmp_path)), []
    stream = queries._out_of_order(t, batches=3, part_bytes=2000)
    writer = stream.writeStream.foreachBatch(lambda batch, _: seen.append(
        [n for n, in batch.groupBy(F.spark_partition_id()).count().select("count").collect()]))
    writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert sum(map(sum, seen)) == 3000 and 1 < len(seen) <= 3
    assert all(len(parts) > 1 and max(parts) <= 2 * min(parts) for parts in seen)


def test_a_restarted_ingestion_takes_files_in_several_micro_batches(spark, tmp_path, monkeypatch, rows):
    """With the result of one for each delivery, though ids repeat and their rows differ."""
    events = [(None if i % 10 == 0 else i % 700, DAY + dt.timedelta(minutes=i), i % 9, "view", float(i), '{"k": "3"}') for i in range(3000)]
    spark.createDataFrame(events, schema_of("events")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    written, write = [], ingest.EventSink.write
    monkeypatch.setattr(ingest.EventSink, "write", lambda self, batch, *rest: (written.append(batch.count()), write(self, batch, *rest)))
    run = lambda: rows(queries.stream_restarted(Tables(spark, str(tmp_path))), "event_type", "events", "ids", "total_price")
    want = run()
    assert len(written) == 3 and sum(written) == 6000 and want[0][1] == want[0][2] == 630
    written.clear()
    monkeypatch.setattr(queries, "parts_of", lambda stored, part_bytes: 6)
    monkeypatch.setattr(queries, "BATCH_BYTES", 300_000)
    assert run() == want
    assert len(written) > 5 and sum(written) == 6000
