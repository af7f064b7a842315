from __future__ import annotations

import datetime as dt
import json
import os
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.sinks import keyindex, once, packing
from tillmark.sources import files, streams
from tillmark.streaming import events as ingest
from tillmark.streaming import progress, signals


def event(n, **changes):
    base = {"event_id": f"E{n}", "event_type": "purchase", "event_timestamp": "2023-06-15T10:00:00Z", "session_id": "s", "user_id": "u",
            "product_id": "P", "product_name": "n", "category": "c", "price": 9.99, "quantity": 2, "device": "mobile", "platform": "ios",
            "referrer": "r", "geo": {"country": "US", "state": "CA"}}
    return {**base, **changes}


CASES = [
    (event(1), None),
    (event(2, event_id=None), "missing_event_id"),
    (event(3, event_id=""), "missing_event_id"),
    (event(4, event_type="INVALID_TYPE"), "unknown_event_type"),
    (event(5, price=-10), "negative_price"),
    (event(6, price="cheap"), "unreadable_price"),
    (event(7, event_timestamp="yesterday"), "unreadable_timestamp"),
    (event(8, product_id=None), "missing_product_id"),
    (event(9, price=0), None),
    (event(10, price=None, geo=None), None),
    (event(11, event_timestamp="2023-06-15T10:00:00"), None),
    (event(12, geo=None, state="NV"), None),
]


def raw(spark, events):
    return spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in events], "value string")


def test_reject_reasons(spark):
    found = ingest.validated(raw(spark, [e for e, _ in CASES])).select("reject_reason").collect()
    assert [r[0] for r in found] == [reason for _, reason in CASES]
    assert ingest.validated(raw(spark, ["{not json"])).first()["reject_reason"] == "malformed_json"


def test_normalised_event(spark):
    found = {r["event_id"]: r for r in ingest.normalised(ingest.validated(raw(spark, [e for e, r in CASES if r is None]))).collect()}
    assert found["E1"]["event_timestamp"] == found["E11"]["event_timestamp"] == dt.datetime(2023, 6, 15, 10)
    assert (found["E1"]["price"], found["E1"]["quantity"], found["E1"]["state"]) == (Decimal("9.99"), 2, "CA")
    assert found["E10"]["state"] is None and found["E12"]["state"] == "NV" and found["E9"]["price"] == 0
    assert len(found["E1"]) == 13


def test_json_is_parsed_once(spark):
    plan = ingest.normalised(ingest.validated(raw(spark, [event(1)])))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


class Ingest:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        (root / "in").mkdir()
        self.sink = ingest.EventSink(str(root / "events"), str(root / "lake"), str(root / "quarantine"))

    def deliver(self, name, events):
        (self.root / "in" / name).write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")

    def run(self, checkpoint="checkpoint"):
        source = streams.json_line_events(self.spark, str(self.root / "in"), max_files=1)
        query = ingest.start_ingest(source, self.sink, str(self.root / checkpoint), every=None)
        query.awaitTermination()
        return ingest.counters(query)

    def ids(self):
        return sorted(r[0] for r in self.spark.read.parquet(self.sink.table).select("event_id").collect())

    def rejected(self):
        return sorted(r[0] for r in self.spark.read.parquet(self.sink.quarantine).select("reject_reason").collect())


@pytest.fixture
def lab(spark, tmp_path):
    return Ingest(spark, tmp_path)


def test_ingestion_resumes_and_replays_without_duplicates(lab, spark):
    lab.deliver("a.json", [e for e, _ in CASES] + ["{broken", event(1)])
    assert lab.run() == {"consumed": 14, "valid": 6, "dropped": 8}
    want = ["E1", "E10", "E11", "E12", "E9"]
    assert lab.ids() == want
    rejected = lab.rejected()
    assert sorted(rejected) == sorted([r for _, r in CASES if r] + ["malformed_json"])

    lab.run()  # nothing new
    assert lab.ids() == want

    lab.deliver("b.json", [event(1, event_timestamp="2023-06-20T00:00:00Z"), event(20)])
    lab.run()  # resumes; a known id is ignored even with another time
    assert lab.ids() == sorted([*want, "E20"])

    lab.run("lost-checkpoint")  # everything again
    assert lab.ids() == sorted([*want, "E20"])


def test_a_replayed_batch_writes_the_same_files(lab, spark):
    batch = ingest.validated(raw(spark, [event(1), event(2, price=-1)])).withColumn(
        "ingested_at", F.lit("2023-06-15 23:30:00").cast("timestamp"))
    for _ in range(2):
        lab.sink.write(batch, 7)
    assert lab.ids() == ["E1"] and lab.rejected() == ["negative_price"]
    back = files.raw_events(spark, lab.sink.lake, "2023-06-15")
    assert [(r["event_id"], r["state"]) for r in back.collect()] == [("E1", "CA")]


def at_once(spark, events):
    return ingest.validated(raw(spark, events)).withColumn("ingested_at", F.lit("2023-06-15 23:30:00").cast("timestamp"))


def test_executors_keep_nothing_of_a_batch(lab, spark, monkeypatch):
    """It lies in a folder while it is written, also if that failed before."""
    kept, add = [], keyindex.KeyIndex.add
    held = lambda: len(spark.sparkContext._jsc.getPersistentRDDs())
    before = held()

    def watched(self, rows, load):
        kept.append((held(), len(list((lab.root / "events__staged").glob("one-0/*")))))
        if len(kept) == 1:
            raise OSError("lost")
        return add(self, rows, load)

    monkeypatch.setattr(keyindex.KeyIndex, "add", watched)
    for n in range(2):
        try:
            lab.sink.write(at_once(spark, [event(1), event(1, event_timestamp="2023-06-14T10:00:00Z"), event(2, price=-1), "{broken"]), 0, "one")
        except OSError:
            assert n == 0
    assert set(kept) == {(before, 2)}
    assert lab.ids() == ["E1"] and lab.rejected() == ["malformed_json", "negative_price"]
    assert sorted(r[0] for r in spark.read.parquet(lab.sink.quarantine).select("value").collect()) == sorted([json.dumps(event(2, price=-1)), "{broken"])
    assert spark.read.parquet(lab.sink.table).select(F.dayofmonth("event_timestamp")).first()[0] == 14
    assert not list((lab.root / "events__staged").glob("*"))


def test_a_micro_batch_of_files_is_bound_by_bytes(lab, spark):
    sizes = []
    for n in range(4):
        lab.deliver(f"{n}.json", [event(i) for i in range(n * 10, n * 10 + 10)])
    two = 2 * (lab.root / "in" / "3.json").stat().st_size + 50
    for most in (two, 1):  # one file at least
        seen = []
        source = streams.json_line_events(spark, str(lab.root / "in"), max_bytes=most)
        writer = source.writeStream.foreachBatch(lambda batch, _, seen=seen: seen.append(batch.count()))
        writer.option("checkpointLocation", str(lab.root / f"c{most}")).trigger(availableNow=True).start().awaitTermination()
        sizes.append(seen)
    assert sizes == [[20, 20], [10, 10, 10, 10]]


def test_many_ids_meet_the_index_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "LITERALS", 10)
    index = keyindex.KeyIndex(str(tmp_path / "ids"), ("event_id",))
    ids = lambda first, last: spark.range(first, last).select(F.format_string("E%d", "id").alias("event_id"))
    index.add(ids(0, 500), "a")
    monkeypatch.setattr(keyindex, "parts_of", lambda stored: 7)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = index.unseen(ids(400, 900))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("hashpartitioning(event_id#") == sum(", 7), " in line for line in plan.splitlines()) == 2
        assert sorted(r[0] for r in fresh.collect()) == sorted(f"E{n}" for n in range(500, 900))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_id_that_comes_back_much_later_is_known(lab, spark):
    for n in range(20):  # enough for the runs of the index to be merged
        lab.sink.write(at_once(spark, [event(n), event(0, event_timestamp=f"20{30 + n}-01-01T00:00:00Z")]), n)
    assert lab.ids() == sorted(f"E{n}" for n in range(20))
    runs = list((lab.root / "events__ids" / "runs").glob("level=*/run=*"))
    assert len(runs) < 16 and any("level=1" in str(r) for r in runs)


@pytest.mark.parametrize("step", ["add", "close"])
def test_a_batch_that_fails_between_table_and_index(lab, spark, monkeypatch, step):
    """Its replay, and other batches before that, add nothing twice and lose nothing."""
    with monkeypatch.context() as broken:
        whole = getattr(keyindex.KeyIndex, step)
        def fail(self, rows, load):
            if load == "one-3":
                raise OSError("lost")
            return whole(self, rows, load)
        broken.setattr(keyindex.KeyIndex, step, fail)
        with pytest.raises(OSError):
            lab.sink.write(at_once(spark, [event(1), event(2)]), 3, "one")
    lab.sink.write(at_once(spark, [event(2), event(4)]), 0, "two")
    assert lab.ids() == ["E1", "E2", "E4"]
    lab.sink.write(at_once(spark, [event(1), event(2)]), 3, "one")
    lab.sink.write(at_once(spark, [event(1), event(2), event(4)]), 1, "two")
    assert lab.ids() == ["E1", "E2", "E4"] and lab.sink.index.doubtful(spark) == []


def test_a_table_without_an_index_gets_one(lab, spark):
    lab.sink.write(at_once(spark, [event(1)]), 0)
    lab.sink = ingest.EventSink(lab.sink.table, lab.sink.lake, lab.sink.quarantine)
    keyindex._delete(spark, lab.sink.index.path)
    lab.sink.write(at_once(spark, [event(1), event(2)]), 1)
    assert lab.ids() == ["E1", "E2"]


def test_two_queries_at_once_add_an_id_once(lab, spark):
    for n in range(4):
        lab.deliver(f"{n}.json", [event(i) for i in range(n * 10, n * 10 + 20)])
    source = lambda: streams.json_line_events(spark, str(lab.root / "in"), max_files=1)
    running = [ingest.start_ingest(source(), lab.sink, str(lab.root / f"c{i}"), every=None, name=f"ingest{i}") for i in range(2)]
    for query in running:
        query.awaitTermination()
    assert lab.ids() == sorted(f"E{n}" for n in range(50))


def test_a_claim_is_waited_for_and_taken_over(spark, tmp_path):
    table = str(tmp_path / "t")
    keyindex._write_text(spark, f"{table}.claim", f"other\n{time.time()}")
    with pytest.raises(TimeoutError), keyindex.one_writer(spark, table, "me", patience=0.3):
        pass
    with keyindex.one_writer(spark, table, "other", patience=0.3):  # restarted
        assert keyindex._read_text(spark, f"{table}.claim").startswith("other")
    keyindex._write_text(spark, f"{table}.claim", f"other\n{time.time() - 5000}")
    with keyindex.one_writer(spark, table, "me", patience=0.3):
        assert keyindex._read_text(spark, f"{table}.claim").startswith("me")
    assert keyindex._read_text(spark, f"{table}.claim") is None


def rows_scanned(df):
    """Rows that the scans of an executed plan gave out."""
    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().apply("numOutputRows").value() if name.startswith("Scan parquet") else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_a_lookup_reads_the_row_groups_that_may_hold_the_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "ROW_GROUP", 64 << 10)
    index = keyindex.KeyIndex(str(tmp_path / "ids"), ("event_id",))
    index.add(spark.range(400_000).select(F.concat(F.lit("E"), "id").alias("event_id")), "first")
    rows = spark.createDataFrame([("E17",), ("E399999",), ("new",)], "event_id string")
    found = index.unseen(rows)
    assert [r[0] for r in found.collect()] == ["new"]
    assert "In(key_hash" in found._jdf.queryExecution().executedPlan().toString().replace("`", "")
    assert rows_scanned(found) < 100_000
    many = spark.range(399_000, 401_000).select(F.concat(F.lit("E"), "id").alias("event_id"))
    assert index.unseen(many).count() == 1000


def test_landed_events_lie_beside_streamed_ones(lab, spark):
    batch = ingest.validated(raw(spark, [event(1)])).withColumn("ingested_at", F.lit("2023-06-15 23:30:00").cast("timestamp"))
    lab.sink.write(batch, 0)
    landed = ingest.parsed(raw(spark, [event(2)])).drop("value", ingest.CORRUPT)
    files.land_events(landed, lab.sink.lake, "2023-06-15")
    files.land_events(landed, lab.sink.lake, "2023-06-16")
    assert sorted(r["event_id"] for r in files.raw_events(spark, lab.sink.lake, "2023-06-15").collect()) == ["E1", "E2"]
    assert files.raw_events(spark, lab.sink.lake, "2023-06-15", "2023-06-16").count() == 3


CLICKS = "event_id string, event_type string, user_id string, ts timestamp, price double"


def clicks(spark, tmp_path, rows, name="in"):
    path = str(tmp_path / name)
    spark.createDataFrame([(str(i), "purchase", u, dt.datetime.fromisoformat(t), 1.0) for i, (u, t) in enumerate(rows)], CLICKS).write.parquet(path)
    return spark.readStream.schema(CLICKS).parquet(path)


def test_sliding_windows_and_upserts(spark, tmp_path):
    stream = clicks(spark, tmp_path, [("u", "2023-01-01 00:10:00"), ("u", "2023-01-01 00:40:00"), ("v", "2023-01-01 01:10:00")])
    windows = signals.windowed_demand(stream, "ts", ["event_type"], "price", "1 hour", "30 minutes").withColumn(
        "day", F.to_date("window_start"))
    signals.start_upserts(windows, str(tmp_path / "t"), ["day", "window_start", "event_type"], ["day"], str(tmp_path / "c"), None).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "t")).orderBy("window_start").collect()
    assert [(r["window_start"].isoformat(), r["events"]) for r in found] == [
        ("2022-12-31T23:30:00", 1), ("2023-01-01T00:00:00", 2), ("2023-01-01T00:30:00", 2), ("2023-01-01T01:00:00", 1)]


def test_sessions_close_behind_the_watermark(spark, tmp_path):
    stream = clicks(spark, tmp_path, [("u", "2023-01-01 00:00:00"), ("u", "2023-01-01 00:20:00"), ("u", "2023-01-01 01:00:00"),
                                      ("v", "2023-01-02 00:00:00")])
    signals.start_append(signals.sessions(stream, "ts", "user_id", "30 minutes", "1 hour"), str(tmp_path / "t"), str(tmp_path / "c"), None).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "t")).orderBy("session_start").collect()
    assert [(r["user_id"], r["events"], r["duration_us"]) for r in found] == [("u", 2, 1_200_000_000), ("u", 1, 0)]


def test_serving_view_prefers_the_batch(spark):
    batch = spark.sql("select date'2023-01-01' d, 1 n union all select date'2023-01-02', 2")
    speed = spark.sql("select date'2023-01-02' d, 9 n union all select date'2023-01-03', 3")
    assert sorted((str(r["d"]), r["n"], r["layer"]) for r in signals.serving_view(batch, speed, "d").collect()) == [
        ("2023-01-01", 1, "batch"), ("2023-01-02", 2, "batch"), ("2023-01-03", 3, "speed")]
    assert signals.serving_view(batch.filter("false"), speed, "d").count() == 2


def test_two_queries_share_a_sink(lab, spark):
    """Batch ids start at 0 in both; the files of neither replace those of the other."""
    lab.deliver("a.json", [event(n) for n in range(5)] + [event(50, price=-1), "{broken"])
    lab.run("first")
    other = lab.root / "other"
    other.mkdir()
    (other / "b.json").write_text("\n".join(json.dumps(event(n)) for n in range(10, 13)) + "\n" + json.dumps(event(60, price=-1)) + "\n")
    source = streams.json_line_events(spark, str(other), max_files=1)
    ingest.start_ingest(source, lab.sink, str(lab.root / "second"), every=None).awaitTermination()
    assert len(lab.ids()) == 8 and lab.rejected() == ["malformed_json", "negative_price", "negative_price"]
    lake = spark.read.json(f"{lab.sink.lake}/raw/ecommerce")
    assert lake.count() == 8 and lake.select("batch").distinct().count() == 2


def _in_batches(spark, tmp_path, rows):
    """One file, and so one micro-batch, per event, in the given order."""
    path, seen = tmp_path / "batches", set()
    for i, (user, ts) in enumerate(rows):
        one = spark.createDataFrame([(str(i), "purchase", user, dt.datetime.fromisoformat(ts), 1.0)], CLICKS).coalesce(1)
        one.write.mode("append").parquet(str(path))
        for file in set(path.glob("*.parquet")) - seen:
            os.utime(file, (1_700_000_000 + 60 * i,) * 2)  # files are taken by their times
            seen.add(file)
    stream = spark.readStream.schema(CLICKS).option("maxFilesPerTrigger", 1).parquet(str(path))
    return stream, spark.read.schema(CLICKS).parquet(str(path))


def test_events_out_of_order_are_all_counted(spark, tmp_path):
    rows = [("u", "2023-01-01 10:00:00"), ("u", "2023-01-03 10:00:00"), ("u", "2023-01-01 10:05:00")]
    stream, events = _in_batches(spark, tmp_path, rows)
    windows = signals.windowed_demand(stream, "ts", ["user_id"], "price", "6 hours").withColumn("day", F.to_date("window_start"))
    keys = ["day", "window_start", "user_id"]
    signals.start_upserts(windows, str(tmp_path / "w"), keys, ["day"], str(tmp_path / "c1"), None).awaitTermination()
    held = spark.read.parquet(str(tmp_path / "w"))
    assert sorted(r["events"] for r in held.collect()) == [1, 2]
    assert signals.late_rows(events, held, "ts", ["user_id"], "6 hours").isEmpty()

    strict = signals.windowed_demand(stream, "ts", ["user_id"], "price", "6 hours", delay="1 hour").withColumn("day", F.to_date("window_start"))
    signals.start_upserts(strict, str(tmp_path / "s"), keys, ["day"], str(tmp_path / "c2"), None).awaitTermination()
    missing = signals.late_rows(events, spark.read.parquet(str(tmp_path / "s")), "ts", ["user_id"], "6 hours")
    # What the stream let go is what the table lacks.
    lost = 3 - spark.read.parquet(str(tmp_path / "s")).agg(F.sum("events")).first()[0]
    assert sum(r["late"] for r in missing.collect()) == lost


def test_windows_without_state_count_late_events(spark, tmp_path):
    rows = [("u", "2023-01-01 10:00:00"), ("u", "2023-01-03 10:00:00"), ("v", "2023-01-01 10:05:00"), ("u", "2023-01-01 11:05:00"), ("u", "2022-12-01 00:00:00")]
    stream, events = _in_batches(spark, tmp_path, rows)
    run = lambda: signals.start_window_totals(
        stream, "ts", ["user_id"], "price", "6 hours", str(tmp_path / "t"), str(tmp_path / "c"), every=None).awaitTermination()
    run()
    want = sorted(map(tuple, signals.windowed_demand(events, "ts", ["user_id"], "price", "6 hours").collect()))
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).drop("day").collect())
    assert read() == want and len(want) == 4
    run()
    assert read() == want


def test_a_repeated_batch_is_added_once(spark, tmp_path, monkeypatch):
    """Whether it failed before, while or after the rows were put in place."""
    path, state = str(tmp_path / "t"), {"n": 0}
    def change(day, n):
        def made():
            rows = spark.createDataFrame([("k", n, dt.date(2023, 1, day))], "k string, n bigint, day date")
            held = once.stored(spark, path, rows.schema).filter(F.col("day") == dt.date(2023, 1, day))
            state["n"] += 1
            return signals.added(held, rows, ["k", "day"], ["n"]), [f"2023-01-{day:02d}"]
        return made
    read = lambda: {str(r["day"]): r["n"] for r in spark.read.parquet(path).collect()}
    assert once.change_once(spark, path, "s", 0, "day", change(1, 5))
    assert not once.change_once(spark, path, "s", 0, "day", change(1, 5)) and read() == {"2023-01-01": 5}
    whole = once.write_partitions
    def torn(rows, path, by):
        whole(rows, path, by)
        raise OSError("lost")
    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(once, "write_partitions", torn)
        once.change_once(spark, path, "s", 1, "day", change(1, 7))
    assert once.change_once(spark, path, "s", 1, "day", change(1, 7)) and read() == {"2023-01-01": 12} and state["n"] == 2
    assert once.change_once(spark, path, "other", 0, "day", change(2, 1)) and read() == {"2023-01-01": 12, "2023-01-02": 1}
    gone = lambda: (spark.createDataFrame([], "k string, n bigint, day date"), ["2023-01-02"])
    assert once.change_once(spark, path, "other", 1, "day", gone) and read() == {"2023-01-01": 12}


@pytest.mark.parametrize("seed", range(3))
def test_sessions_of_events_in_any_order(spark, tmp_path, seed):
    """Late events that extend sessions, and bridge two of different days, against sessions of all events."""
    rng = random.Random(seed)
    rows = [("u", "2023-01-01 10:00:00"), ("u", "2023-01-01 11:00:00"), ("v", "2023-01-03 10:00:00"), ("u", "2023-01-01 08:00:00"),
            ("u", "2023-01-02 01:00:00"), ("u", "2023-01-01 17:00:00"), ("u", "2023-01-01 19:30:00"), ("v", "2023-01-03 16:00:00")]
    rows += [(rng.choice("uvw"), f"2023-01-0{rng.randint(1, 5)} {rng.randint(0, 23):02d}:00:00") for _ in range(4)]
    if seed:
        rng.shuffle(rows)
    stream, events = _in_batches(spark, tmp_path, rows)
    signals.start_sessions(stream, "ts", "user_id", "6 hours", str(tmp_path / "t"), str(tmp_path / "c"), None).awaitTermination()
    found = signals.with_duration(spark.read.parquet(str(tmp_path / "t")))
    want = events.groupBy(F.session_window("ts", "6 hours").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))
    assert sorted((r["user_id"], r["session_start"], r["last_event"], r["events"]) for r in found.collect()) == sorted(
        (r["user_id"], r["w"]["start"], r["last"], r["n"]) for r in want.collect())


def test_the_progress_log_holds_more_batches_than_spark(lab, spark, tmp_path):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        for n in range(5):
            lab.deliver(f"{n}.json", [event(n), event(100 + n, price=-1)])
        source = streams.json_line_events(spark, str(lab.root / "in"), max_files=1)
        query = ingest.start_ingest(source, lab.sink, str(lab.root / "checkpoint"), every=None)
        progress.finished(query)
        assert ingest.counters(query)["consumed"] < 10
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    found = {r["metric"]: (r["value"], r["batches"]) for r in progress.counters(spark, str(tmp_path / "log")).collect()}
    assert found == {"consumed": (10, 5), "valid": (5, 5), "dropped": (5, 5)}
    assert progress.counters(spark, str(tmp_path / "none")).isEmpty()


def test_batches_are_bounded_and_nothing_is_lost(lab, spark):
    """A processing-time trigger over many files, three a batch."""
    for n in range(8):
        lab.deliver(f"{n}.json", [event(n)])
    source = streams.json_line_events(spark, str(lab.root / "in"), max_files=3)
    query = ingest.start_ingest(source, lab.sink, str(lab.root / "checkpoint"), every="1 second")
    try:
        query.processAllAvailable()
        sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    assert len(sizes) >= 3 and max(sizes) <= 3 and len(lab.ids()) == 8


def test_hours_are_packed_and_repeated_batches_left_out(lab, spark):
    at = lambda hour, events: ingest.validated(raw(spark, events)).withColumn("ingested_at", F.lit(f"2023-06-15 {hour}:30:00").cast("timestamp"))
    for n in range(3):
        lab.sink.write(at("10", [event(n)]), n)
    lab.sink.write(at("11", [event(10)]), 3)
    lab.sink.write(at("12", [event(11)]), 4)
    read = lambda: sorted(r["event_id"] for r in files.raw_events(spark, lab.sink.lake, "2023-06-15").collect())
    want = read()
    assert len(want) == 5
    hours = lab.root / "lake" / "raw" / "ecommerce" / "year=2023" / "month=06" / "day=15"
    assert packing.pack_hours(spark, lab.sink.lake, dt.datetime(2023, 6, 15, 11)) == 1
    assert [p.name for p in (hours / "hour=10").glob("batch=*")] == ["batch=packed"] and read() == want
    lab.sink.write(at("10", [event(1)]), 1)  # repeated after its hour was packed
    assert read() == want
    lab.sink.write(at("10", [event(20)]), 9)  # an hour that was not closed after all
    assert packing.pack_hours(spark, lab.sink.lake, dt.datetime(2023, 6, 15, 13)) == 1
    assert read() == sorted([*want, "E20"]) and len(list((hours / "hour=10").glob("batch=*"))) == 1
    assert packing.packed_batches(spark, str(hours / "hour=10")) == {"stream-0", "stream-1", "stream-2", "stream-9"}
    assert packing.pack_hours(spark, lab.sink.lake, dt.datetime(2023, 6, 15, 13)) == 0
    assert sorted(p.name for p in (lab.root / "lake" / "raw").iterdir() if not p.name.startswith(".")) == ["ecommerce"]
