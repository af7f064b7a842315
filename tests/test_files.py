from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillmark.functions.joins import lookup
from tillmark.operators import runlog
from tillmark.session import run_dir, shared_dir
from tillmark.sinks import lake
from tillmark.sources import files, warehouse


# The layout of the tills' own files, written out so that a changed schema is noticed.
HEADER = ("transaction_id,transaction_date,transaction_time,store_id,store_name,city,state,region,product_id,product_name,category,brand,"
          "unit_price,quantity,discount,total_amount,payment_method,customer_id")


def pos_file(root, day, *lines, header=HEADER):
    folder = root / "raw" / "pos" / files.partition_path("", "", "", day).split("//")[-1].lstrip("/")
    folder.mkdir(parents=True)
    (folder / "pos.csv").write_text("\n".join([header, *lines]) + "\n")


LINE = "{},2023-11-{},10:00:00,S1,Store,City,CA,West,P1,,Toys,Brand,{},2,,20.0,Cash,"


def test_partition_path():
    assert files.partition_path("lake", "raw", "pos", "2023-01-05") == "lake/raw/pos/year=2023/month=01/day=05"


def test_raw_sales_of_a_day_and_of_a_range(spark, tmp_path):
    for n in ("14", "15", "16"):
        pos_file(tmp_path, f"2023-11-{n}", LINE.format(f"T{n}", n, "NaN" if n == "15" else "10.0"))
    day = files.raw_pos(spark, str(tmp_path), "2023-11-15")
    row = day.first()
    assert row["transaction_id"] == "T15" and row["product_name"] is None and row["customer_id"] is None and row["discount"] is None
    assert row["quantity"] == 2 and row["unit_price"] != row["unit_price"] and row["source_day"] == dt.date(2023, 11, 15)
    assert files.raw_pos(spark, str(tmp_path), "2023-11-14", "2023-11-15").count() == 2
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [((" in plan or "year" in plan.split("PartitionFilters: [")[1][:200]


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    swapped = HEADER.replace("unit_price,quantity", "quantity,unit_price")
    pos_file(tmp_path, "2023-11-14", LINE.format("T", "14", "10"), header=swapped)
    with pytest.raises(Exception, match="header"):
        files.raw_pos(spark, str(tmp_path), "2023-11-14").collect()


def test_sales_partitions_are_replaced_by_day_of_delivery(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("a", dt.date(2023, 1, 1), dt.date(2023, 1, 1)), ("b", dt.date(2023, 1, 1), dt.date(2023, 1, 2))],
                                 "transaction_id string, transaction_date date, source_day date")
    lake.write_sales(rows, root)
    lake.write_sales(rows.filter("transaction_id = 'b'").withColumn("transaction_id", F.lit("c")), root)
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/processed/pos_fact").select("transaction_id").collect()) == ["a", "c"]
    assert (tmp_path / "processed/pos_fact/year=2023/month=01/day=02").is_dir()
    assert [r["transaction_id"] for r in files.processed_sales(spark, root, "2023-01-03", 1).collect()] == ["c"]
    assert files.processed_sales(spark, root, "2023-01-03", 30).count() == 2


def test_events_are_split_by_type(spark, tmp_path):
    rows = spark.createDataFrame([("1", "purchase", dt.datetime(2022, 12, 31, 5), dt.date(2023, 1, 1))],
                                 "event_id string, event_type string, event_timestamp timestamp, source_day date")
    lake.write_events(rows, str(tmp_path))
    assert (tmp_path / "processed/ecommerce_events/year=2023/month=01/day=01/event_type=purchase").is_dir()


def test_lookup_files(spark, tmp_path):
    (tmp_path / "w.csv").write_text("date,state,temp_high_f,temp_low_f,precipitation_in,snow_in,condition\n"
                                    "2023-01-01,CA,61.5,50,0.1,0,Rain\nbroken,CA,hot,50,,0,Sun\n")
    good, bad = files.weather(spark, str(tmp_path / "w.csv")).collect()
    assert (good["weather_date"], good["temp_high_f"]) == (dt.date(2023, 1, 1), 61.5)
    assert bad["weather_date"] is None and bad["temp_high_f"] is None
    (tmp_path / "h.csv").write_text("date,holiday_name,is_federal\n2023-07-04,Independence Day,True\n")
    assert tuple(files.holidays(spark, str(tmp_path / "h.csv")).first()) == (dt.date(2023, 7, 4), "Independence Day", True)
    assert dict(files.inferred_csv(spark, str(tmp_path / "w.csv")).dtypes)["snow_in"] == "int"


def test_event_array_sample(spark, tmp_path):
    (tmp_path / "e.json").write_text('[{"event_id": "1", "price": 5.5, "geo": {"state": "CA"}}, {"event_id": "2"}]')
    rows = files.event_array_file(spark, str(tmp_path / "e.json")).orderBy("event_id").collect()
    assert [(r["event_id"], r["price"]) for r in rows] == [("1", "5.5"), ("2", None)] and rows[0]["geo"]["state"] == "CA"


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_exports_keep_runs_and_a_latest_copy(spark, tmp_path, fmt):
    root = str(tmp_path / "x")
    for run, n in (("r1", 1), ("r2", 2)):
        lake.export_dataset(spark.range(n).withColumn("s", F.lit("a,b")), root, run, fmt)
    read = spark.read.option("header", True).csv if fmt == "csv" else spark.read.parquet
    assert [read(f"{root}/{p}").count() for p in ("run_ts=r1", "run_ts=r2", "latest")] == [1, 2, 2]
    with pytest.raises(ValueError):
        lake.export_dataset(spark.range(1), root, "r3", "xlsx")


def test_export_by_run_date(spark, tmp_path):
    for day, n in (("2023-01-01", 1), ("2023-01-02", 2), ("2023-01-02", 3)):
        path = lake.export_by_run_date(spark.range(n), str(tmp_path), day)
    counts = {str(r["dt"]): r["count"] for r in spark.read.option("header", True).csv(path).groupBy("dt").count().collect()}
    assert counts == {"2023-01-01": 1, "2023-01-02": 3}


def test_table_can_be_replaced_by_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "dim")
    lake.replace_table(spark.range(3), path)
    lake.replace_table(spark.read.parquet(path).withColumn("id", F.col("id") * 10), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [0, 10, 20]
    assert [p.name for p in tmp_path.iterdir()] == ["dim"]


def test_dataset_and_check_log(spark, tmp_path):
    root = str(tmp_path)
    for n in (3, 2):
        path = lake.write_dataset(spark.range(n), root, "agg")
    assert spark.read.parquet(path).count() == 2
    results = spark.sql("select 'c' check_name, 't' table_name, 'PASS' status")
    for run, phase in (("r1", "pre_load"), ("r1", "pre_load"), ("r1", "post_load_check"), ("r2", "pre_load")):
        log = lake.append_check_log(results, root, run, phase)
    assert spark.read.parquet(log).count() == 3


def test_warehouse_read_prunes_and_pushes_down(spark, tmp_path):
    spark.sql("select 1 a, 2 b, 3 c").write.parquet(str(tmp_path / "t"))
    df = warehouse.table(spark, str(tmp_path), "t", ["a"], F.col("b") > 1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(b,1)" in plan and "ReadSchema: struct<a:int,b:int>" in plan and df.count() == 1


def test_lookup_is_marked_only_below_the_limit(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    small = spark.read.parquet(str(tmp_path / "t"))
    marked = lambda: "broadcast" in lookup(small.select("id"), small)._jdf.queryExecution().analyzed().toString().lower()
    assert marked()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for off in ("10", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", off)
            assert not marked()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_run_records(spark, tmp_path):
    path = str(tmp_path / "m")
    good = runlog.RunRecord("job", "1")
    good.record("a", 2)
    good.increment("a")
    good.observed(spark.range(7), rows=F.count(F.lit(1))).write.format("noop").mode("overwrite").save()
    good.finish(spark, path)
    bad = runlog.RunRecord("job", "2")
    bad.error("boom")
    bad.observed(spark.range(7), rows=F.count(F.lit(1)))
    bad.finish(spark, path, "failed")
    rows = {r["run_id"]: r for r in spark.read.parquet(path).collect()}
    assert rows["1"]["metrics"]["a"] == 3 and rows["1"]["metrics"]["rows"] == 7 and rows["1"]["status"] == "success"
    assert rows["2"]["errors"] == ["boom"] and rows["2"]["status"] == "failed"


def test_alerts(spark):
    start = dt.datetime(2023, 1, 1)
    lag = [("c", "consumer_lag", start + dt.timedelta(minutes=m), 20000.0 if m not in (3, 9) else 5.0) for m in range(20)]
    samples = spark.createDataFrame([*lag, ("pos_etl", "elapsed_sec", start, 4000.0), ("pos_etl", "failed", start, 1.0),
                                     ("quick", "elapsed_sec", start, 40.0)], "pipeline string, metric string, ts timestamp, value double")
    found = sorted((r["alert"], r["pipeline"], r["minutes"]) for r in runlog.alerts(samples).collect())
    # A silence of nine hours is no run of two samples.
    apart = [("c", "consumer_lag", start + dt.timedelta(hours=h), 20000.0) for h in (0, 9)]
    assert runlog.alerts(spark.createDataFrame(apart, samples.schema)).isEmpty()
    # 10..19 and 4..8 are above; only the first run of them lasts five minutes.
    assert found == [("KafkaConsumerLagHigh", "c", 10), ("PipelineETLFailed", "pos_etl", 1), ("PipelineETLSlow", "pos_etl", 1)]
