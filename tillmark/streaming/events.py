"""Event ingestion: parse, validate, route.

The same functions serve a stream and a batch.  A micro-batch is written three
times (event table, raw lake, quarantine), each write idempotent, so replaying it
after a failure changes nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillmark.functions.dates import parse_event_time
from tillmark.functions.ordering import first_per_key
from tillmark.operators.merge import read_if_exists
from tillmark.schemas import EVENT_COLUMNS, EVENT_TYPES, RAW_EVENT
from tillmark.sinks.keyindex import KeyIndex, _delete, one_writer
from tillmark.sinks.packing import packed_batches
from tillmark.sources.files import with_day_columns

REQUIRED = ("event_id", "event_type", "event_timestamp", "product_id")
CORRUPT = "_corrupt"


def parsed(raw: DataFrame) -> DataFrame:
    """The raw ``value`` text next to its event fields; unreadable text gives no fields.

    `inline` makes the fields columns after a single parse; as plain struct fields
    each use of one would parse the text again.
    """
    schema = T.StructType([*RAW_EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    event = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    return raw.select(*raw.columns, F.inline(F.array(event)))


def reject_reason(event_types: Sequence[str] = tuple(EVENT_TYPES)) -> Column:
    """Why an event is rejected, or null; the first failed rule counts."""
    price = F.expr("try_cast(price as double)")
    rules = [(F.col(CORRUPT).isNotNull(), "malformed_json")]
    rules += [(F.coalesce(F.col(c), F.lit("")) == "", f"missing_{c}") for c in REQUIRED]
    rules += [
        (~F.col("event_type").isin(list(event_types)), "unknown_event_type"),
        (F.col("price").isNotNull() & price.isNull(), "unreadable_price"),
        (price < 0, "negative_price"),
        (parse_event_time("event_timestamp").isNull(), "unreadable_timestamp"),
    ]
    reason = F.lit(None).cast("string")
    for failed, name in reversed(rules):
        reason = F.when(failed, F.lit(name)).otherwise(reason)
    return reason


def validated(raw: DataFrame, event_types: Sequence[str] = tuple(EVENT_TYPES)) -> DataFrame:
    return parsed(raw).withColumn("reject_reason", reject_reason(event_types))


def normalised(events: DataFrame, *extra: str) -> DataFrame:
    """The flat event: typed time, price and quantity, state lifted out of ``geo``."""
    typed = {
        "event_timestamp": parse_event_time("event_timestamp"),
        "price": F.expr("try_cast(price as decimal(10,2))"),
        "quantity": F.expr("try_cast(quantity as int)"),
        "state": F.coalesce("geo.state", "state"),
    }
    return events.select(*[typed.get(c, F.col(c)).alias(c) for c in EVENT_COLUMNS], *extra)


def _staged(rows: DataFrame, path: str) -> DataFrame:
    """The rows, computed once into a folder."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@dataclass(frozen=True)
class EventSink:
    """Where a micro-batch goes.

    A batch's event ids are looked up in an index of all ids beside the table, which also finds one that comes back
    with another time, however late; the table itself is not read.  Queries that share a table take turns.

    While a batch is written, its events and the first one of each id lie in a folder beside the table, so it is read,
    parsed and sorted once and executors keep none of it in memory.  A replay writes that folder anew.
    """

    table: str
    lake: str
    quarantine: str

    @property
    def index(self) -> KeyIndex:
        return KeyIndex(f"{self.table}__ids", ("event_id",))

    def write(self, batch: DataFrame, batch_id: int, stream: str = "stream") -> None:
        """``stream`` tells queries apart that share the sink: batch ids start anew with every checkpoint."""
        load = f"{stream}-{batch_id}"
        staged = f"{self.table}__staged/{load}"
        try:
            # The text of a valid event is in its fields.
            text = F.when(F.col("reject_reason").isNotNull(), F.col("value"))
            batch = _staged(batch.withColumn("value", text), f"{staged}/events").withColumn("batch", F.lit(load))
            valid = normalised(batch.filter("reject_reason is null"), "ingested_at", "batch")
            self._quarantine(batch.filter("reject_reason is not null"))
            self._append_raw(valid)
            rows = first_per_key(valid.drop("batch"), ["event_id"], ["event_timestamp"])
            rows = rows.withColumnRenamed("ingested_at", "load_timestamp").withColumn("event_date", F.to_date("event_timestamp"))
            rows = _staged(rows, f"{staged}/rows")
            with one_writer(batch.sparkSession, self.table, stream):
                self._insert(rows, load)
        finally:
            _delete(batch.sparkSession, staged)

    def _insert(self, rows: DataFrame, load: str) -> None:
        """New event ids only.

        A batch that failed between the table and the index is replayed with the same rows, so it finds its own in
        the days it wrote; until then, other batches look there, too.
        """
        spark, index = rows.sparkSession, self.index
        table = read_if_exists(spark, self.table, rows.schema)
        if not index.exists(spark):
            # A table from before there was an index, or none yet.
            index.add(table, "first")
        fresh = index.unseen(rows)
        if doubtful := index.doubtful(spark):
            held = table.filter(F.col("event_date").isin([dt.date.fromisoformat(d) for d in doubtful])).select("event_id")
            fresh = fresh.join(held, "event_id", "left_anti")
        # Bounded by the calendar.
        index.open(spark, load, [str(r[0]) for r in rows.select("event_date").distinct().collect()])
        fresh.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(self.table)
        # All keys of the batch, as a replay writes the same run again.
        index.add(rows, load)
        index.close(spark, load)
        index.settle(spark, rows.schema)

    def _append_raw(self, valid: DataFrame) -> None:
        """JSON lines by ingest hour; the ingest time is the batch's, so a replay lands in the same place."""
        lines = with_day_columns(valid, "ingested_at").withColumn("hour", F.date_format("ingested_at", "HH"))
        # A batch has one ingest time.  One that is repeated after its hour was packed is in there.
        for row in lines.select("year", "month", "day", "hour", "batch").distinct().collect():
            hour = f"year={row.year}/month={row.month}/day={row.day}/hour={row.hour}"
            if row.batch in packed_batches(valid.sparkSession, f"{self.lake}/raw/ecommerce/{hour}"):
                return
        (lines.drop("ingested_at").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "month", "day", "hour", "batch").json(f"{self.lake}/raw/ecommerce"))

    def _quarantine(self, rejected: DataFrame) -> None:
        rows = rejected.select("event_id", "reject_reason", "value", "ingested_at",
                               F.to_date("ingested_at").alias("ingest_date"), "batch")
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ingest_date", "batch").parquet(self.quarantine))


def start_ingest(raw: DataFrame, sink: EventSink, checkpoint: str, every: str | None = "30 seconds",
                 event_types: Sequence[str] = tuple(EVENT_TYPES), name: str = "event_ingest") -> StreamingQuery:
    """Run the ingestion; ``every=None`` drains what is there and stops.

    The checkpoint is what makes a restart resume: use one folder per query.
    """
    # In a stream current_timestamp() is the batch's time and is replayed with it.
    events = validated(raw, event_types).withColumn("ingested_at", F.current_timestamp())
    counted = events.observe(
        name,
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("reject_reason").isNull()).alias("valid"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("dropped"),
    )
    # The checkpoint's folder stands for the query: it stays the same when the query is started again.
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id, stream)

    writer = counted.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def counters(query: StreamingQuery) -> dict[str, int]:
    """Consumed, valid and dropped events over the progress Spark still holds."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        for observed in progress.observedMetrics.values():
            for key, value in observed.asDict().items():
                totals[key] = totals.get(key, 0) + (value or 0)
    return totals
