"""Keyed merges on plain Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.joins import fits_broadcast
from tillmark.functions.ordering import first_per_key
from tillmark.sinks.lake import path_exists, write_partitions


def latest_per_key(source: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """The newest source row per key; a merge needs unique source keys."""
    ordered = source.withColumn("_newest", -F.col(order_by).cast("timestamp").cast("double"))
    return first_per_key(ordered, list(keys), ["_newest"]).drop("_newest")


class UnfitSource(ValueError):
    """Rows to merge have no key, or share one and differ."""


def unfit_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that cannot be merged, with the ``reason``: ``null_key``, or ``ambiguous_key`` if rows of one key differ."""
    others = [c for c in source.columns if c not in keys]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    clashing = source.filter(~null_key).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return source.filter(null_key).withColumn("reason", F.lit("null_key")).unionByName(
        source.join(clashing, list(keys), "left_semi").select(*source.columns).withColumn("reason", F.lit("ambiguous_key"))).select(
        *keys, *others, "reason")


def unique_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key.  A row without a key, or rows of one key that differ, stop the job when they are met.

    Repeated keys would multiply rows, and null keys be inserted on every run.  `unfit_rows` finds such rows
    beforehand; `latest_per_key` chooses by time.  Equal rows count once, without a shuffle of their own.
    """
    others = [c for c in source.columns if c not in keys]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    named = source.withColumn(keys[0], F.when(null_key, F.raise_error(F.lit(f"a row to merge has no {', '.join(keys)}"))).otherwise(F.col(keys[0])))
    if not others:
        return named.distinct()
    row = F.struct(*[F.col(c) for c in others])
    ambiguous = F.raise_error(F.concat(F.lit(f"rows to merge differ for {', '.join(keys)} "), F.to_json(F.struct(*keys))))
    found = named.groupBy(*keys).agg(F.min(row).alias("_low"), F.max(row).alias("_high")).withColumn(
        "_low", F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(ambiguous))
    return found.select(*keys, "_low.*").select(*source.columns)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str] | None = None) -> DataFrame:
    """Insert new keys, and on known keys overwrite ``update_cols`` (default: all but the keys).

    A null in the source overwrites, too: whether a row has a source is decided by
    a marker, not by the value.  Target columns the source lacks stay as they are.
    """
    source = unique_keys(source, keys)
    updates = set(update_cols if update_cols is not None else [c for c in source.columns if c not in keys])
    t, s = target.withColumn("_in_target", F.lit(True)), source.withColumn("_in_source", F.lit(True))
    t, s = t.alias("t"), s.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    known, fresh = F.col("_in_target").isNotNull(), F.col("_in_source").isNotNull()

    def merged(name: str) -> Column:
        if name in keys:
            return F.coalesce(f"t.{name}", f"s.{name}")
        if name not in source.columns:
            return F.col(f"t.{name}")
        if name in updates:
            return F.when(fresh, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        return F.when(known, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))

    return t.join(s, on, "full_outer").select(*[merged(c).alias(c) for c in target.columns])


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  as_small_as: DataFrame | None = None) -> DataFrame:
    """The source rows whose key the target does not have yet.

    Plainly, both sides are shuffled by key.  ``as_small_as`` names a table the
    source has no more rows than: if that is known to be small, the target's keys
    are first filtered by the broadcast source keys while they are scanned, and
    the target is not shuffled.
    """
    known = target.select(*keys)
    if as_small_as is not None and fits_broadcast(as_small_as):
        known = known.join(F.broadcast(source.select(*keys)), list(keys), "left_semi")
    return source.join(known, list(keys), "left_anti")


def read_if_exists(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at the path, or an empty one before its first load."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def upsert_partitioned(source: DataFrame, path: str, keys: Sequence[str], partition_cols: Sequence[str],
                       update_cols: Sequence[str] | None = None) -> str:
    """Merge into a partitioned table, touching only the partitions the source has rows in.

    The partition columns must be part of the key, so a key cannot move.  Spark
    stages dynamic overwrites and swaps partitions after all tasks are done, so
    the partitions being read may be replaced; the merge is idempotent by key, so
    a repeated run gives the same table.
    """
    if not set(partition_cols) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    target = read_if_exists(source.sparkSession, path, source.schema)
    # The touched partitions are bounded by the calendar; as literals they prune the scan.
    touched = [row.asDict() for row in source.select(*partition_cols).distinct().collect()]
    if not touched:
        return path
    first = partition_cols[0]
    target = target.filter(F.col(first).isin(list({row[first] for row in touched})))
    if len(partition_cols) > 1:
        target = target.join(source.select(*partition_cols).distinct(), list(partition_cols), "left_semi")
    return write_partitions(merge_upsert(target, source, keys, update_cols), path, partition_cols)


def scd2_merge(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], as_of: str) -> DataFrame:
    """Close the open version of every changed key on ``as_of`` and open a new one.

    Columns `effective_from`, `effective_to` (null = open) and `is_current_record`.
    Keys absent from ``incoming`` keep their open version; repeating the same merge
    changes nothing.  One full outer join does all of it.
    """
    day = F.lit(as_of).cast("date")
    others = [c for c in dim.columns if c not in ("effective_from", "effective_to", "is_current_record")]
    history, current = dim.filter("not is_current_record"), dim.filter("is_current_record")
    incoming = unique_keys(incoming, [key])
    d, i = current.alias("d"), incoming.withColumn("_in", F.lit(True)).alias("i")
    both = d.join(i, F.col(f"d.{key}") == F.col(f"i.{key}"), "full_outer")
    is_new = F.col(f"d.{key}").isNull()
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"d.{c}").eqNullSafe(F.col(f"i.{c}"))
    changed = F.col("_in").isNotNull() & (is_new | differs)
    old = F.struct(
        *[F.col(f"d.{c}").alias(c) for c in others],
        F.col("d.effective_from").alias("effective_from"),
        F.when(changed, day).alias("effective_to"),
        (~changed).alias("is_current_record"),
    )
    new = F.struct(
        *[(F.col(f"i.{c}") if c in incoming.columns else F.col(f"d.{c}")).alias(c) for c in others],
        day.alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current_record"),
    )
    versions = F.array_compact(F.array(F.when(~is_new, old), F.when(changed, new)))
    return history.unionByName(both.select(F.explode(versions).alias("v")).select("v.*"))


def as_of_version(facts: DataFrame, dim: DataFrame, key: str, day: str, every: str = "month") -> DataFrame:
    """Facts with the dimension version valid on their day (from inclusive, to exclusive).

    Versions of a key must not overlap.  Facts and versions meet by key and month (``every``), a version in each month it
    is valid in.  As versions hold for whole days, a fact meets at most as many as a month has days, however many its key has,
    and a key with many facts is spread over the months; within one, the join is split at run time.
    """
    span = facts.agg(F.min(day), F.max(day)).first()
    first, last = F.lit(span[0]).cast("date"), F.lit(span[1]).cast("date")
    since, until = F.col("effective_from"), F.col("effective_to")
    months = F.sequence(F.trunc(F.greatest(since, first), every), F.trunc(F.least(F.coalesce(F.date_sub(until, 1), last), last), every),
                        F.expr(f"interval 1 {every}"))
    valid = dim.filter((since <= last) & (until.isNull() | ((until > first) & (until > since)))).withColumn(
        "_slice", F.explode(months)).withColumnsRenamed({key: "_key"})
    dated = facts.withColumn("_month", F.trunc(day, every))
    on = (dated[key] == valid["_key"]) & (dated["_month"] == valid["_slice"]) & (valid["effective_from"] <= dated[day]) & (
        valid["effective_to"].isNull() | (dated[day] < valid["effective_to"]))
    return dated.join(valid, on).drop("_key", "_slice", "_month")
