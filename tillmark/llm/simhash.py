"""Near duplicates by SimHash, found through one-wildcard variants of fingerprint halves."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import per_text, ship, table, text_of
from tillmark.llm.components import least_reachable
from tillmark.session import materialised

ship(sys.modules[__name__])

BITS = 64
SEED = 42
#: Words per shingle, and the number of bits in which linked fingerprints may differ at most.
SHINGLE = 3
RADIUS = 2
#: Members of a variant's bucket that are compared with each other; larger buckets are linked through shared neighbours.
BUCKET = 32


def folded(hashes: np.ndarray) -> int:
    """SimHash of shingle hashes: a bit is set if over half of them have it."""
    counts = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(hashes), 65536):  # bounded memory however long the text
        rows = hashes[part:part + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles; 0 without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return folded(np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], dtype="<u8"))


def simhashes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``bits``, the SimHash as a signed long, instead of its text; null texts count as empty."""
    def values(text: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in text.to_pylist()], dtype=np.uint64).view(np.int64))

    return per_text(docs, "bits long", lambda text: [values(text)])


def _variants(points: DataFrame) -> DataFrame:
    """Every fingerprint under both halves, each with one of its bits cut out: 64 rows of (bits, key).

    A key holds which half and bit it is above the other bits of the half.
    """
    half = F.when(F.col("variant") < 32, F.col("bits").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("bits", 32))
    key = half.bitwiseAND(F.expr("~shiftleft(1L, variant % 32)")).bitwiseOR(F.expr("shiftleft(cast(variant as bigint), 32)"))
    return points.select("bits", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("variant")).select("bits", key.alias("key"))


def _neighbours() -> Column:
    """The fingerprint in ``bits`` and the 64 that differ from it in one bit."""
    flipped = F.expr(f"transform(sequence(0, {BITS - 1}), i -> bits ^ shiftleft(1L, i))")
    return F.concat(F.array("bits"), flipped)


def near_links(points: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct ``bits`` at most two bits apart.

    A fingerprint is cut into two halves.  Of two fingerprints two bits apart at most,
    one half differs in at most one bit, so both have the same variant of that half with
    the bit cut out.  Fingerprints meet under equal variants and are verified.  Only
    variants that occur more than once move on.  Buckets of more than ``bucket``
    members are not paired: their members are linked through the point between them,
    since two fingerprints are two bits apart at most exactly if they share a
    point that differs from each in at most one bit.  So every link between texts of large
    groups is found as well, at 65 rows per fingerprint instead of a square.
    """
    variants = _variants(points)
    shared = materialised(
        variants.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    # The keys that occur more than once grow with the corpus, so they are shuffled, not broadcast, at any size.
    met = materialised(variants.join(shared.hint("merge"), "key"), "met")

    small = met.filter(F.col("n") <= bucket).groupBy("key").agg(F.array_sort(F.collect_list("bits")).alias("members"))
    pairs = (
        small.select(F.explode("members").alias("a"), "members")
        .select("a", F.explode(F.filter("members", lambda b: (b > F.col("a")) & (
            F.bit_count(b.bitwiseXOR(F.col("a"))) <= RADIUS))).alias("b"))
    )
    crowded = met.filter(F.col("n") > bucket).select("bits").distinct()
    points_of = crowded.select("bits", F.explode(_neighbours()).alias("point"))
    centre = points_of.groupBy("point").agg(F.min("bits").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = points_of.join(centre, "point").select(F.col("least").alias("a"), F.col("bits").alias("b")).filter("a != b")
    return pairs.unionAll(stars).distinct()


def near_duplicate_groups(
    docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET, carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id``, ``bits``, ``root`` and ``component_id`` of every row of ``docs``, and the columns named by ``carry``.

    The component is named by its smallest doc_id; ``root`` is its least fingerprint.  Texts
    without a word have fingerprint 0 and are linked like any other.  Null texts count as
    empty; rows with a null id are linked but name no component (it is null if there is no
    other); repeated rows come back as often as they came; other columns are ignored; no
    rows give no rows.
    """
    prints = materialised(simhashes(docs.select("doc_id", "text", *carry), shingle), "simhash")
    least = materialised(prints.groupBy("bits").agg(F.min("doc_id").alias("doc_id")), "least")
    # Few bytes become 64 rows each: keep them from being read by one task.
    points = least.select("bits").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    roots = materialised(least_reachable(near_links(points, bucket)), "roots")
    rooted = least.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "doc_id", F.coalesce("root", "bits").alias("root"))
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(names, "root").select("bits", "root", "component_id")
    return prints.join(named, "bits").select("doc_id", "bits", "root", "component_id", *carry)


def keep_one_per_group(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` of each component with all its columns: that of the smallest id, then of the smallest text hash."""
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.sha2(text_of(), 256).alias("sha")).alias("_key")
    groups = near_duplicate_groups(docs.select("doc_id", "text", key), carry=["_key"], **options)
    kept = groups.groupBy("root").agg(F.min("_key").alias("_key")).select("_key")
    rows = docs.select(key, F.struct("*").alias("_row"))
    return rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
