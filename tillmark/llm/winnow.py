"""Document fingerprints by winnowing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.llm.common import WORD, ascii_lower, table, text_of
from tillmark.session import materialised

#: Words per gram and grams per window: any run of GRAM + WINDOW - 1 shared words shares a mark.
GRAM = 5
WINDOW = 8
#: A longer word counts as all its runs of so many characters, so text without white space has grams that don't depend on
#: where the word begins: any LONGEST + GRAM + WINDOW - 2 shared characters inside such words share a mark.
LONGEST = 16
#: Documents that are followed to the next one in a task.
FOLLOWED = 10_000

#: A gram's key holds its hash above the bits below, and its position from the end of the text in those bits.  36 bits of
#: hash tell the grams of two texts apart; an index over all grams of a large corpus would want more.
PLACE_BITS = 28
PLACE_MASK = (1 << PLACE_BITS) - 1


def marks(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The winnowed grams of a text, as sorted distinct longs; see :func:`hash_of` and :func:`place_of`.

    Words are hashed, every ``gram`` neighbouring word hashes give a gram hash, and
    of every ``window`` neighbouring grams the least is marked, the rightmost one of
    equals.  A text with fewer words is one gram, one with fewer grams one window;
    a text without a word has no marks.  Letters A-Z count as a-z.
    """
    def runs(word: Column) -> Column:
        return F.when(F.length(word) <= LONGEST, F.array(word)).otherwise(
            F.regexp_extract_all(word, F.lit(f"(?s)(?=(.{{{LONGEST}}}))"), F.lit(1)))

    def keyed(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(hashes) - gram + 1, F.lit(1))),
            # The larger position has the smaller low bits, so the rightmost of equal hashes is the least.
            lambda i: F.xxhash64(F.slice(hashes, i, gram)).bitwiseAND(~PLACE_MASK).bitwiseOR(
                F.lit(PLACE_MASK) - i.cast("long").bitwiseAND(PLACE_MASK)))

    def winnowed(keys: Column) -> Column:
        return F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(keys) - window + 1, F.lit(1))),
            lambda i: F.array_min(F.slice(keys, i, window))))

    nothing = F.array().cast("array<bigint>")
    # A lambda over a one-element array binds each step's array, so that it is computed once.
    once = lambda value, then: F.element_at(F.transform(F.array(value), then), 1)
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    words = once(found, lambda w: F.when(F.exists(w, lambda x: F.length(x) > LONGEST), F.flatten(F.transform(w, runs))).otherwise(w))
    return once(F.transform(words, lambda w: F.xxhash64(w)),
                lambda w: F.when(F.size(w) == 0, nothing).otherwise(once(keyed(w), winnowed)))


def hash_of(mark: Column) -> Column:
    return F.shiftright(mark, PLACE_BITS)


def place_of(mark: Column) -> Column:
    """Number of the gram, from 1 (modulo 2 to the power of PLACE_BITS)."""
    return F.lit(PLACE_MASK) - mark.bitwiseAND(PLACE_MASK)


def grams(marked: Column) -> Column:
    """The distinct hashes of marks, without their places."""
    return F.array_distinct(F.transform(marked, hash_of))


def likeness(left: Column, right: Column) -> Column:
    """Share of the distinct hashes of two texts that both have; two texts without any are alike."""
    shared = F.size(F.array_intersect(left, right))
    total = F.size(left) + F.size(right) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared.cast("double") / total)


def digest(marked: Column) -> Column:
    """SHA-256 of the marks with their places, in text order."""
    return F.sha2(F.array_join(F.transform(
        marked, lambda m: F.concat_ws("@", F.hex(hash_of(m)), place_of(m).cast("string"))), ","), 256)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc_id`` and ``marks`` of every row of ``docs``; null texts count as empty."""
    return docs.select("doc_id", marks(text_of(), gram, window).alias("marks"))


def successors(docs: DataFrame) -> DataFrame:
    """Key and length of every document with the key of the next one, by descending id; the last has the first.

    Keys are (doc_id, SHA-256 of the text); null ids come last, equal ids go by the
    hash, and rows that agree in both are one document.  Only keys are moved: they are
    range-partitioned, followed inside a partition, and the last of a partition takes
    the first of the next, of which there is one row per partition.
    """
    keys = docs.select(F.struct("doc_id", F.unhex(F.sha2(text_of(), 256)).alias("sha")).alias("key"), F.length(text_of()).alias("n"))
    order = [F.col("key.doc_id").desc_nulls_last(), F.col("key.sha").asc()]
    slices = max(1, math.ceil(docs.count() / FOLLOWED))
    ranged = materialised(
        keys.dropDuplicates(["key"]).repartitionByRange(slices, *order).withColumn("part", F.spark_partition_id()), "keys")
    inside = Window.partitionBy("part").orderBy(*order)
    followed = ranged.withColumn("next", F.lead("key").over(inside)).withColumn(
        "nth", F.row_number().over(inside))
    heads = followed.filter("nth = 1").select("part", F.col("key").alias("head"))
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per partition: the head of the following partition, for the last one that of the first.
    heads = heads.select("part", F.coalesce(
        F.lead("head").over(Window.orderBy("part")), F.first("head").over(by_part)).alias("after"))
    return followed.join(heads, "part").select("key", "n", F.coalesce("next", "after").alias("next"))


def compare_with_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Every document with its marks, those of its edited text, and the likeness to that and to the next document.

    The edited text has the last floor(n/3) code points replaced by the first as many
    (or all) of the next document in descending order of ids; after the last comes the
    first, so a single document follows itself.  Columns: doc_id, n_chars, marks,
    edited_sha256, edited_marks, near_edited, near_next.  See :func:`successors` for
    null and repeated ids; null texts count as empty, other columns are ignored, no
    rows give no rows.
    """
    after = materialised(successors(docs), "next")
    # Marks are computed where the texts are read; both sides below then read the same exchange of texts with their marks.
    own = docs.select(
        F.struct("doc_id", F.unhex(F.sha2(text_of(), 256)).alias("sha")).alias("key"), text_of().alias("text"),
        marks(text_of(), gram, window).alias("marks")).dropDuplicates(["key"])
    # What a document needs of the next one: as much of its beginning as is replaced, and its hashes.
    lent = own.select(F.col("key").alias("next"), F.col("text").alias("_other"), F.col("marks").alias("_marks")).join(after, "next").select(
        "key", F.substring("_other", F.lit(1), F.expr("n div 3").cast("int")).alias("tail"), grams(F.col("_marks")).alias("next_grams"), "n")
    both = own.join(lent, "key").select(
        "key.doc_id", F.col("n").cast("long").alias("n_chars"), "marks", "next_grams",
        F.concat(F.substring("text", F.lit(1), F.col("n") - F.expr("n div 3").cast("int")), "tail").alias("_edited"))
    compared = both.select("doc_id", "n_chars", "marks", "next_grams", F.sha2("_edited", 256).alias("edited_sha256"),
                           marks(F.col("_edited"), gram, window).alias("edited_marks"))
    return compared.select(
        "doc_id", "n_chars", "marks", "edited_sha256", "edited_marks",
        likeness(grams(F.col("marks")), grams(F.col("edited_marks"))).alias("near_edited"),
        likeness(grams(F.col("marks")), F.col("next_grams")).alias("near_next"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", digest(F.col("marks")).alias("fingerprint"),
        digest(F.col("edited_marks")).alias("edited_fingerprint"), "near_edited", "near_next",
        F.size("marks").alias("n_marks"))
