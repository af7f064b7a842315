"""Exact duplicates through integer names of blocks, pairs of blocks, and whole texts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import ascii_lower, integer_names, table, text_of
from tillmark.session import materialised

BLOCK = 4096
KEY = ["doc_id", "_sha"]


def _blocks(docs: DataFrame, block: int, fingerprint: Callable[[Column], Column]) -> DataFrame:
    """One row per block: document key, position, number of blocks, fingerprint and content."""
    norm = docs.select("doc_id", ascii_lower(text_of()).alias("_norm"))
    cut = F.regexp_extract_all("_norm", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return (
        norm.select("doc_id", F.unhex(F.sha2("_norm", 256)).alias("_sha"),
                    F.when(F.col("_norm") == "", F.array(F.lit(""))).otherwise(cut).alias("_cut"))
        .select(*KEY, F.size("_cut").cast("long").alias("_n"), F.posexplode("_cut").alias("_pos", "_block"))
        .withColumn("_pos", F.col("_pos").cast("long"))
        .withColumn("_print", fingerprint(F.col("_block")))
    )


def _named_blocks(blocks: DataFrame) -> DataFrame:
    """Document key, position and number of blocks with the name of each block.

    Contents meet once, under their fingerprint: if the least and the greatest
    content of a fingerprint agree, it stands for one content and its occurrences
    need not carry text any further.  Contents that share a fingerprint are named
    one by one.
    """
    kinds = materialised(
        blocks.groupBy("_print").agg(F.min("_block").alias("_lo"), F.max("_block").alias("_hi"))
        .select("_print", (F.col("_lo") != F.col("_hi")).alias("_mixed")), "kinds")
    mixed = kinds.filter("_mixed").select("_print")
    clash = not mixed.isEmpty()
    keys = kinds.filter("not _mixed").select("_print", F.lit(None).cast("string").alias("_block"))
    if clash:
        contents = blocks.select("_print", "_block").join(mixed, "_print", "left_semi")
        keys = keys.unionByName(contents.distinct())
    names = materialised(integer_names(keys, ["_print", "_block"], "_name"), "names")

    single = names.filter(F.col("_block").isNull()).select("_print", "_name")
    columns = [*KEY, "_pos", "_n", "_name"]
    named = blocks.select(*KEY, "_pos", "_n", "_print").join(single, "_print").select(*columns)
    if clash:
        several = names.filter(F.col("_block").isNotNull())
        named = named.unionByName(blocks.join(several, ["_print", "_block"]).select(*columns))
    return named


def text_identities(
    docs: DataFrame, block: int = BLOCK, fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``doc_id``, ``_sha`` (SHA-256 of the normalised text), ``_level`` and ``_name`` of every document.

    Two documents have the same level and name exactly if their texts agree after
    A-Z are lower-cased.  Blocks of fixed size get integer names in sorted order;
    then neighbouring names are paired and the pairs named, until one name is left
    (a last name without a neighbour is paired with -1, so the level tells lengths
    apart).  The number of rounds grows with the logarithm of the longest text.

    Null texts count as empty.  Rows that agree in id and text are one document; a
    null id is an id like any other; other columns are ignored; no rows give no rows.
    """
    current = materialised(
        _named_blocks(_blocks(docs, block, fingerprint)).dropDuplicates([*KEY, "_pos"]), "named")
    done = [current.filter("_n = 1").withColumn("_level", F.lit(0))]
    longest = current.agg(F.max("_n")).first()[0] or 1
    level = 0
    while longest > 1:
        level += 1
        left, right = F.col("_pos") % 2 == 0, F.col("_pos") % 2 == 1
        pairs = materialised(
            current.filter("_n > 1")
            .groupBy(*KEY, F.expr("_pos div 2").alias("_pos"))
            .agg(F.expr("(max(_n) + 1) div 2").alias("_n"),
                 F.max(F.when(left, F.col("_name"))).alias("_left"),
                 F.coalesce(F.max(F.when(right, F.col("_name"))), F.lit(-1)).alias("_right")), "pairs")
        current = materialised(
            pairs.join(integer_names(pairs, ["_left", "_right"], "_name"), ["_left", "_right"])
            .select(*KEY, "_pos", "_n", "_name"), "named")
        done.append(current.filter("_n = 1").withColumn("_level", F.lit(level)))
        longest = (longest + 1) // 2
    return reduce(DataFrame.unionByName, done).select(*KEY, "_level", "_name")


def exact_duplicates(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """Each document with the one that stays of its equals: the largest id of the group.

    Columns: doc_id, keep_id, group_size, kept, text_sha256.  A null id stays only
    where its group has no other.  See :func:`text_identities` for odd input.
    """
    same = ["_level", "_name"]
    found = text_identities(docs, block, **options)
    groups = found.groupBy(*same).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return found.join(groups, same).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, once each, with all their columns."""
    kept = exact_duplicates(docs, block).filter("kept").select(
        F.struct("doc_id", F.col("text_sha256").alias("sha")).alias("_key"))
    rows = docs.select(
        F.struct("doc_id", F.sha2(ascii_lower(text_of()), 256).alias("sha")).alias("_key"), F.struct("*").alias("_row"))
    return rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
