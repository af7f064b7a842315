"""Event-time aggregates: same-day demand, sessions, deduplication, and serving.

These carry out what the platform's design promises of its stream: same-day
demand signals, session durations, and a view over batch and stream.

Tables of windows and sessions are kept up batch by batch, without state in the
stream: what a batch adds is merged into the partitions it touches, once (see
`change_once`).  So nothing grows with time, and an event counts however late it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillmark.operators.merge import upsert_partitioned
from tillmark.sinks.once import change_once, stored


def windowed_demand(events: DataFrame, ts: str, keys: Sequence[str], value: str, size: str,
                    slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Events and value per key and event-time window (tumbling, or sliding by ``slide``).

    As a stream, every window stays in the state unless there is a ``delay``: then windows that ended so long before the
    newest event are let go, and later events of theirs with them, which `late_rows` finds.  `start_window_totals`
    needs no state and loses none.
    """
    timed = events.withWatermark(ts, delay) if delay else events
    totals = timed.groupBy(F.window(ts, size, slide), *keys).agg(
        F.count(F.lit(1)).alias("events"), F.sum(value).alias("total_value"))
    return totals.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         *keys, "events", "total_value")


def sessions(events: DataFrame, ts: str, key: str, gap: str, delay: str = "1 hour") -> DataFrame:
    """Sessions split where a key is silent for ``gap``, with their duration.

    The window ends one gap after the last event, so the duration is the last
    event's time minus the first's.  A stream hands out a session when the watermark passes its end, and lets go of
    events later than that; `start_sessions` keeps a table that holds all of them.
    """
    found = events.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("session"), key).agg(
        F.count(F.lit(1)).alias("events"), F.max(ts).alias("last_event"),
        F.max((F.col("event_type") == "purchase").cast("int")).alias("has_purchase"))
    return with_duration(found.select(key, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
                                      "last_event", "events", "has_purchase")).drop("last_event")


def with_duration(found: DataFrame) -> DataFrame:
    return found.withColumn("duration_us", F.unix_micros("last_event") - F.unix_micros("session_start"))


def _stream_name(checkpoint: str) -> str:
    """The checkpoint's folder stands for the query: it stays the same when the query is started again."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _each_batch(events: DataFrame, path: str, by: str, checkpoint: str, every: str | None,
                change: Callable[[DataFrame], tuple[DataFrame, Sequence[str]]]) -> StreamingQuery:
    """Run ``change`` once for every micro-batch on the table at the path."""
    stream = _stream_name(checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            change_once(batch.sparkSession, path, stream, batch_id, by, lambda: change(batch))
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def added(target: DataFrame, partial: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Rows with the sums of both sides per key; a key of either side is kept."""
    columns = [*keys, *sums]
    return target.select(*columns).unionByName(partial.select(*columns)).groupBy(*keys).agg(
        *[F.sum(c).cast(partial.schema[c].dataType).alias(c) for c in sums])


def start_window_totals(events: DataFrame, ts: str, keys: Sequence[str], value: str, size: str, path: str, checkpoint: str,
                        slide: str | None = None, every: str | None = "30 seconds") -> StreamingQuery:
    """Keep a table of `windowed_demand`, partitioned by the day its windows begin.

    A micro-batch is summed by itself and its sums are added to the stored windows; only the days it has events of are
    read and written again.  The stream has no state, and late events are added like any others.
    """
    def change(batch: DataFrame) -> tuple[DataFrame, list[str]]:
        partial = windowed_demand(batch, ts, keys, value, size, slide).withColumn("day", F.to_date("window_start")).persist()
        # Bounded by the calendar.
        days = [r[0] for r in partial.select("day").distinct().collect()]
        held = stored(batch.sparkSession, path, partial.schema).filter(F.col("day").isin(days))
        return added(held, partial, ["window_start", "window_end", *keys, "day"], ["events", "total_value"]), [str(d) for d in days]

    return _each_batch(events, path, "day", checkpoint, every, change)


def merged_sessions(found: DataFrame, key: str, gap: str) -> DataFrame:
    """Sessions united where one begins no later than a gap after another's last event, as Spark's session windows are.

    ``found`` has the key, session_start, last_event, events, has_purchase and ``is_new``; ``old_days`` are the days of
    the united sessions that were stored, and ``changed`` tells whether a new one is among them.
    """
    ordered = Window.partitionBy(key).orderBy("session_start", "last_event")
    reached = F.max("last_event").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("session_start") > F.col("_reached") + F.expr(f"interval {gap}"), F.lit(True))
    island = F.sum(F.col("_starts").cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    numbered = found.withColumn("_reached", reached).withColumn("_starts", starts).withColumn("_island", island)
    return numbered.groupBy(key, "_island").agg(
        F.min("session_start").alias("session_start"), F.max("last_event").alias("last_event"), F.sum("events").alias("events"),
        F.max("has_purchase").alias("has_purchase"), F.max("is_new").alias("changed"),
        F.collect_set(F.when(~F.col("is_new"), F.col("day"))).alias("old_days"),
        F.collect_set(F.when(~F.col("is_new"), F.struct("session_start", "day"))).alias("old"),
    ).drop("_island").withColumn("day", F.to_date("last_event"))


def start_sessions(events: DataFrame, ts: str, key: str, gap: str, path: str, checkpoint: str,
                   every: str | None = "30 seconds") -> StreamingQuery:
    """Keep a table of all sessions, partitioned by the day of their last event.

    A micro-batch is cut into sessions by itself.  Stored sessions of the same keys that end no earlier than one gap before the
    batch begins are fetched and united with them, so an event that comes late extends a session or bridges two.  Only
    the days of the sessions that change are written again.  A key meets its sessions, not its events, in one task.
    """
    def change(batch: DataFrame) -> tuple[DataFrame, list[str]]:
        spark = batch.sparkSession
        new = batch.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(F.session_window(ts, gap).alias("_w"), key).agg(
            F.max(ts).alias("last_event"), F.count(F.lit(1)).alias("events"),
            F.max((F.col("event_type") == "purchase").cast("int")).alias("has_purchase"))
        new = new.select(key, F.col("_w.start").alias("session_start"), "last_event", "events", "has_purchase",
                         F.to_date("last_event").alias("day")).persist()
        span = new.agg(F.to_date(F.min("session_start") - F.expr(f"interval {gap}")), F.max("last_event")).first()
        table = stored(spark, path, new.schema)
        near = table.filter((F.col("day") >= F.lit(span[0])) & (F.col("session_start") <= F.lit(span[1]) + F.expr(f"interval {gap}"))).join(
            new.select(key).distinct(), key, "left_semi")
        united = merged_sessions(near.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True))), key, gap)
        changed = united.filter("changed").persist()
        # Bounded by the calendar.
        days = sorted({r[0] for r in changed.select(F.explode(F.array_union("old_days", F.array("day")))).distinct().collect()})
        absorbed = changed.select(key, F.explode("old").alias("o")).select(key, "o.session_start", "o.day")
        kept = table.filter(F.col("day").isin(days)).join(absorbed, [key, "session_start", "day"], "left_anti")
        return kept.unionByName(changed.select(*new.columns)), [str(d) for d in days]

    return _each_batch(events, path, "day", checkpoint, every, change)


def late_rows(events: DataFrame, windows: DataFrame, ts: str, keys: Sequence[str], size: str) -> DataFrame:
    """Per key and window, how many events of a batch the table of windows lacks."""
    counted = events.groupBy(F.window(ts, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("_all"))
    known = windows.select(F.col("window_start").alias("_start"), *[F.col(k).alias(f"_{k}") for k in keys], F.col("events").alias("_held"))
    on = F.col("w.start") == F.col("_start")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    missing = F.col("_all") - F.coalesce("_held", F.lit(0))
    return counted.join(known, on, "left").select(
        F.col("w.start").alias("window_start"), *keys, missing.alias("late")).filter("late > 0")


def deduplicated(events: DataFrame, ts: str, key: str = "event_id", delay: str = "1 hour") -> DataFrame:
    """The first of each event id; ids are remembered as long as the watermark needs them."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def start_upserts(aggregate: DataFrame, path: str, keys: Sequence[str], partition_cols: Sequence[str],
                  checkpoint: str, every: str | None = "30 seconds") -> StreamingQuery:
    """Keep a table equal to a running aggregate: every update is merged by key.

    Only partitions with changed keys are rewritten, and only changed keys leave
    the state store, unlike in complete mode.
    """
    def merge(batch: DataFrame, _batch_id: int) -> None:
        batch = batch.persist()
        try:
            upsert_partitioned(batch, path, keys, partition_cols)
        finally:
            batch.unpersist()

    writer = aggregate.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def start_append(rows: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds",
                 partition_cols: Sequence[str] = ()) -> StreamingQuery:
    """Append finished rows to Parquet; Spark's file sink commits each batch exactly once."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start(path)


def serving_view(batch: DataFrame, speed: DataFrame, day: str) -> DataFrame:
    """Batch rows, and stream rows only for days after the last batch day."""
    # A single date.
    last = batch.agg(F.max(day)).first()[0]
    fresh = speed if last is None else speed.filter(F.col(day) > F.lit(last))
    return (batch.withColumn("layer", F.lit("batch"))
            .unionByName(fresh.select(*batch.columns).withColumn("layer", F.lit("speed"))))
