"""Expressions and small helpers the text operators share."""

from __future__ import annotations

import string
import sys
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType
from typing import TypeVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillmark.session import materialised

T = TypeVar("T")

#: Words are runs of anything but these six ASCII characters.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

#: Distinct keys are named in this many slices; it bounds how many one task sorts, not how many there are.
NAME_SLICES = 4096

#: Bits of the bitmap that :func:`may_hold` broadcasts, as a power of two: 8 MB.
FILTER_BITS = 26

#: Rows that Python works on at a time.
SLICE = 500

#: Bytes that Spark hands to Python at a time, or one row if that has more.
BATCH = 2 << 20

#: Rows whose id hashes to this remainder are held out when a model is fitted.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(module: ModuleType) -> None:
    """Send a module's functions to the workers by value, so that they need no copy of this package."""
    cloudpickle.register_pickle_by_value(module)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; pure ASCII texts take Spark's fast path."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from model fitting: crc32 of its id as text is a multiple of five; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def joined(spans: Column) -> Column:
    """kind:start:end of every span (kind, start, stop), comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def integer_names(keys: DataFrame, columns: Sequence[str], alias: str = "name") -> DataFrame:
    """Distinct rows of ``columns`` with one integer each, the same in every run over the same rows.

    Rows are dealt into slices by hash, sorted within each, and numbered there; the
    slice is the number's remainder.  Copies are dropped before the shuffle.
    """
    sliced = keys.select(*columns).distinct().withColumn(
        "_slice", F.pmod(F.xxhash64(*columns), F.lit(NAME_SLICES)))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(*columns)).cast("long")
    return sliced.withColumn(alias, place * NAME_SLICES + F.col("_slice")).drop("_slice")


def may_hold(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, negate: bool = False) -> DataFrame:
    """The ``rows`` whose 64-bit ``key`` may be among the wanted ones, without a shuffle; with ``negate`` the surely others.

    The wanted keys set bits of a bitmap of 2 ** FILTER_BITS, a few megabytes however many they are, which is broadcast.
    Some other rows pass as well, so an exact join has to follow; it then ships few rows that it does not need.
    """
    def bit(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))

    marks = wanted.select(bit(wanted_key).alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_marks"))
    marked = rows.withColumn("_bit", bit(key)).withColumn("_bucket", F.bitmap_bucket_number("_bit")).join(
        F.broadcast(materialised(marks, "marks")), "_bucket", "left")
    place = F.bitmap_bit_position("_bit")
    byte = F.conv(F.hex(F.substring("_marks", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.expr("getbit(_byte, cast(_place % 8 as int)) = 1"), F.lit(False))
    found = marked.withColumn("_place", place).withColumn("_byte", byte).filter(~hit if negate else hit)
    return found.select(*[F.col(c) for c in rows.columns])


def in_small_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python in batches of ``BATCH`` bytes.

    Spark's own bound is 64 MB, which the executor, Python and what Python makes of it hold in every task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, to bound what Python holds of them at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def per_text(rows: DataFrame, added: str, function: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """``rows`` with its column ``text`` replaced by the columns ``added`` (DDL), computed in Arrow batches.

    ``function`` gets the texts of a batch and returns one array for each added column.
    All other columns pass through untouched, but for those whose names are needed.
    """
    in_small_batches(rows.sparkSession)
    fields = StructType.fromDDL(added)
    keep = [c for c in rows.columns if c.lower() not in ("text", *(f.name.lower() for f in fields))]
    schema = rows.select(*keep).schema
    for field in fields:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *function(batch.column("text"))], names=schema.names)

    return rows.mapInArrow(run, schema)


def on_workers(spark: SparkSession, model: T) -> Callable[[], T]:
    """A function that gives tasks the model, sent once per executor and unpacked once per worker process."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(model))

    def get() -> T:
        if not hasattr(packed, "unpacked"):
            packed.unpacked = cloudpickle.loads(packed.value)
        return packed.unpacked

    return get


ship(sys.modules[__name__])
