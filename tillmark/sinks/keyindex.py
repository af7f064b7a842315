"""The keys a table holds, kept beside it, so that a load need not scan the table for them.

The keys lie in sorted runs.  Each is in the order of the keys' hash, with bloom
filters on it, so looking up the keys of a small load reads only the row groups
that can hold them.  Every load adds a run; runs of a like size are merged into
one, so their number grows with the logarithm of the number of loads, and a key
is rewritten as often.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.joins import fits_broadcast, parts_of
from tillmark.sinks.lake import _hadoop_path, path_exists

#: Up to so many keys are looked up as literals, which Parquet's statistics and bloom filters can use.  The session
#: setting spark.sql.parquet.pushdown.inFilterThreshold must not be smaller.
LITERALS = 1000
#: Runs of one level that are merged into one of the next.
FAN = 8
#: Bytes of a row group: what a lookup reads at least for a key that may be there.
ROW_GROUP = 4 << 20

_LOCKS: dict[str, threading.RLock] = {}
_LOCKS_LOCK = threading.Lock()


def _write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not be there yet; whether that succeeded."""
    location, fs = _hadoop_path(spark, path)
    try:
        out = fs.create(location, False)
    except Py4JJavaError:
        if fs.exists(location):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if it is gone."""
    location, fs = _hadoop_path(spark, path)
    try:
        stream = fs.open(location)
    except Py4JJavaError:
        return None
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    location, fs = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(location)) if fs.exists(location) else []


def _delete(spark: SparkSession, path: str) -> None:
    location, fs = _hadoop_path(spark, path)
    fs.delete(location, True)


@contextmanager
def one_writer(spark: SparkSession, path: str, owner: str, patience: float = 600, expires: float = 3600) -> Iterator[None]:
    """Hold the claim on a table, so that check-then-write is done by one writer at a time.

    Queries of one application exclude each other by a lock; applications by a claim file, whose creation
    must be atomic in the table's store, as it is in HDFS.  An owner that died with its claim takes it up again
    when it restarts; others take it over after ``expires`` seconds, which must be longer than any load.
    """
    with _LOCKS_LOCK:
        lock = _LOCKS.setdefault(path, threading.RLock())
    until = time.monotonic() + patience
    if not lock.acquire(timeout=patience):
        raise TimeoutError(f"{path} is being written by another query")
    claim = f"{path}.claim"
    try:
        while not _write_text(spark, claim, f"{owner}\n{time.time()}"):
            held = (_read_text(spark, claim) or "").split("\n")
            if held[0] == owner:
                break
            if len(held) == 2 and time.time() - float(held[1]) > expires:
                _delete(spark, claim)
            elif time.monotonic() > until:
                raise TimeoutError(f"{path} is claimed by {held[0]}")
            else:
                time.sleep(0.2)
        try:
            yield
        finally:
            _delete(spark, claim)
    finally:
        lock.release()


@dataclass(frozen=True)
class KeyIndex:
    """The distinct values of ``keys`` that the table beside ``path`` holds.

    A load runs under `one_writer`: `unseen` tells its new rows, `open` notes that it has begun and which of the
    table's partitions it writes, the table is written, `add` adds the keys, `close` ends it.  A load that dies
    in between leaves its note; `doubtful` names the partitions where rows without an entry in the index may be.
    """

    path: str
    keys: tuple[str, ...]

    @property
    def _runs(self) -> str:
        return f"{self.path}/runs"

    @property
    def _notes(self) -> str:
        return f"{self.path}/open"

    def hash(self) -> Column:
        return F.xxhash64(*self.keys)

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self._runs)

    def entries(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """``key_hash`` and the keys, some more than once."""
        held = T.StructType([T.StructField("key_hash", T.LongType()), *[schema[k] for k in self.keys]])
        if not self.exists(spark):
            return spark.createDataFrame([], held)
        return spark.read.schema(T.StructType([*held, T.StructField("level", T.IntegerType()), T.StructField("run", T.StringType())])).parquet(
            self._runs).select(*held.names)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not in the index; keys must not be null.

        Few rows are looked up by the literal hashes of their keys; more are joined with all entries, in parts of
        their stored size, so that tasks do not grow with the index.
        """
        spark = rows.sparkSession
        entries = self.entries(spark, rows.schema)
        # At most LITERALS + 1 rows.
        hashes = [r[0] for r in rows.select(self.hash()).distinct().limit(LITERALS + 1).collect()]
        if len(hashes) <= LITERALS:
            # As many entries as there are hashes, times the runs that repeat them.
            known = F.broadcast(entries.filter(F.col("key_hash").isin(hashes)).select(*self.keys))
        else:
            known = entries.select(*self.keys)
            parts = parts_of(entries)
            # A key has one row and few entries, so none is hot.
            if parts > 1 and not fits_broadcast(known):
                rows, known = rows.repartition(parts, *self.keys), known.repartition(parts, *self.keys)
        return rows.join(known, list(self.keys), "left_anti")

    def _write(self, entries: DataFrame, level: int, run: str) -> None:
        (entries.repartitionByRange("key_hash").sortWithinPartitions("key_hash", *self.keys).write.mode("overwrite")
         .option("partitionOverwriteMode", "static")
         .option("parquet.bloom.filter.enabled#key_hash", "true").option("parquet.block.size", str(ROW_GROUP))
         .parquet(f"{self._runs}/level={level}/run={run}"))

    def add(self, rows: DataFrame, load: str) -> None:
        """Add the keys of the rows as the run of this load; again, if it has one already."""
        self._write(rows.select(self.hash().alias("key_hash"), *self.keys).distinct(), 0, load)

    def open(self, spark: SparkSession, load: str, partitions: Sequence[str]) -> None:
        _delete(spark, f"{self._notes}/{load}")
        _write_text(spark, f"{self._notes}/{load}", "\n".join(partitions))

    def close(self, spark: SparkSession, load: str) -> None:
        _delete(spark, f"{self._notes}/{load}")

    def doubtful(self, spark: SparkSession) -> list[str]:
        """The partitions named by loads that have begun and not ended."""
        found: set[str] = set()
        for note in _names(spark, self._notes):
            if not note.startswith("."):
                found.update(filter(None, (_read_text(spark, f"{self._notes}/{note}") or "").split("\n")))
        return sorted(found)

    def settle(self, spark: SparkSession, schema: T.StructType, fan: int = FAN) -> None:
        """Merge the runs of every level that has ``fan`` of them into one run of the next.

        The merged run is whole before the others go, so a failure in between leaves keys twice, which does no harm.
        """
        level = 0
        while runs := [n for n in _names(spark, f"{self._runs}/level={level}") if n.startswith("run=")]:
            if len(runs) >= fan:
                held = T.StructType([T.StructField("key_hash", T.LongType()), *[schema[k] for k in self.keys]])
                folders = [f"{self._runs}/level={level}/{n}" for n in runs]
                self._write(spark.read.schema(held).parquet(*folders).distinct(), level + 1, uuid.uuid4().hex)
                for folder in folders:
                    _delete(spark, folder)
            level += 1
