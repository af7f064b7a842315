"""Near duplicates by Jaccard similarity: circulant MinHash, bands, and verification on full sets."""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import may_hold, per_text, ship, table, text_of
from tillmark.llm.components import least_reachable
from tillmark.llm.simhash import folded, near_links
from tillmark.session import materialised

ship(sys.modules[__name__])

SEED = 42
#: Words per shingle of the query, and percent of the union that two sets must share.
SHINGLE = 2
PERCENT = 80
#: Coordinates per band, and bands.  Sets of similarity s meet unless all bands differ: (1 - s ** 5) ** 32, 3e-6 at 0.8.
ROWS = 5
BANDS = 32
#: Shingles whose coordinates are computed at a time.
PART = 512
#: Members of a bucket that a task compares others with at a time.
SLICE = 512
#: Standard errors that the share of equal coordinates may fall short of the similarity.
SLACK = 6


def shingles(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; fewer words are one shingle, no words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64))


def permuted(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit integers, in place: odd multiplications and shifted xors, all of them invertible."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(15)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, size: int = ROWS * BANDS) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least value of one permutation over the set, as another one, shifted by k, places it."""
    placed = permuted((hashes ^ (hashes >> np.uint64(32))).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    shifts = np.arange(size, dtype=np.uint32)
    least = np.full(size, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(placed), PART):
        np.minimum(least, permuted(placed[at:at + PART, None] + shifts, 0x7FEB352D, 0x846CA68B).min(axis=0), out=least)
    return least


def prints_of(shingle: int, simhash: bool = False):
    """Digest, size, bands and sketch (a byte of every coordinate) of texts, and with ``simhash`` that of the set."""
    def run(texts: pa.Array) -> list[pa.Array]:
        digests, sizes, bands, sketches, bits = [], [], [], [], []
        for text in texts.to_pylist():
            found = shingles(text, shingle)
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            sizes.append(len(found))
            low = signature(found)
            bands.append(np.array([xxhash.xxh64_intdigest(low[i:i + ROWS].tobytes(), i) for i in range(0, len(low), ROWS)],
                                  dtype=np.uint64).view(np.int64) if len(found) else [])
            sketches.append(low.astype(np.uint8).tobytes())
            bits.append(folded(found) if simhash else 0)
        columns = [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
        return columns + ([pa.array(np.array(bits, dtype=np.uint64).view(np.int64))] if simhash else [])

    return run


def _fits(a: Column | str, b: Column | str, percent: int) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _alike(percent: int) -> Column:
    """Whether as many bytes of the sketches ``_s`` and ``_t`` agree as similar sets have, but for SLACK standard errors."""
    size, least = ROWS * BANDS, percent / 100
    wanted = math.floor(size * least - SLACK * math.sqrt(size * least * (1 - least)))
    pieces = F.sequence(F.lit(1), F.lit(size))
    same = F.filter(pieces, lambda i: F.substring("_s", i, F.lit(1)) == F.substring("_t", i, F.lit(1)))
    return F.size(same) >= wanted


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar.  Of each pair only one set is sent to the other."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("_left"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("_right"))
    both = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    shared = F.size(F.array_intersect("_left", "_right"))
    return both.filter(100 * shared >= F.lit(percent) * (F.size("_left") + F.size("_right") - shared)).select("a", "b")


def _sketched(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sketches do not rule the similarity out."""
    sketches = nodes.select("node", "sketch")
    return pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("_s")), "a").join(
        sketches.select(F.col("node").alias("b"), F.col("sketch").alias("_t")), "b").filter(_alike(percent)).select("a", "b")


def by_fingerprint(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes with the same SimHash ``bits``, or with fingerprints that :func:`near_links` links.

    The least node stands for a fingerprint; the others with it meet that one.  Pairs whose sizes rule the similarity out
    are left out, and so are sets without a shingle.
    """
    named = nodes.filter("size > 0").select("bits", "node", "size")
    least = materialised(named.groupBy("bits").agg(F.min(F.struct("node", "size")).alias("_least")).select(
        "bits", "_least.*"), "least")
    # Few bytes become 64 rows each: keep them from being read by one task.
    points = least.select("bits").repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    first, second = (least.select(*[F.col(c).alias(f"{c}_{side}") for c in least.columns]) for side in "ab")
    near = near_links(points).join(first, F.col("a") == F.col("bits_a")).join(second, F.col("b") == F.col("bits_b")).select(
        "node_a", "size_a", "node_b", "size_b")
    same = named.select(F.col("bits").alias("bits_a"), F.col("node").alias("node_b"), F.col("size").alias("size_b")).join(
        first, "bits_a").filter("node_a != node_b").select("node_a", "size_a", "node_b", "size_b")
    return near.unionAll(same).filter(_fits("size_a", "size_b", percent)).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes are not of one component yet."""
    first, second = (roots.select(F.col("node").alias(side), F.col("root").alias(f"_{side}")) for side in "ab")
    return pairs.join(first, "a", "left").join(second, "b", "left").filter(
        F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def compared(percent: int):
    """Links between the asking rows of a slice of a bucket and the rows whose home it is."""
    def run(rows: pa.Table) -> pa.Table:
        node, root, size, at = (rows.column(c).to_numpy() for c in ("node", "root", "size", "place"))
        home, asks = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("home", "asks"))
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        lists = rows.column("members").combine_chunks()
        flat, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(lists.value_lengths().to_numpy())
        parts = [flat[end - n:end] for n, end in zip(size, ends, strict=True)]
        found: list[tuple[int, int]] = []
        for i in np.flatnonzero(asks):
            other = home & (root != root[i]) & (~asks | (node > node[i]))
            other &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
            near = np.flatnonzero(other)
            # A pair is compared where it meets first; an earlier bucket has both, or had one as its centre.
            near = near[~(bands[near][:, :at[0]] == bands[i][None, :at[0]]).any(axis=1)]
            if len(near):
                beside = np.concatenate([parts[j] for j in near])
                spots = np.minimum(np.searchsorted(parts[i], beside), len(parts[i]) - 1)
                shared = np.add.reduceat(parts[i][spots] == beside, np.concatenate([[0], np.cumsum(size[near])[:-1]]), dtype=np.int64)
                linked = near[100 * shared >= percent * (size[near] + size[i] - shared)]
                found += [(int(node[i]), int(node[j])) for j in linked]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _left_over(met: DataFrame, centres: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of a bucket that are of several components after the comparison with its centre.

    Members are dealt into slices of a bucket; those outside its largest component go to all slices of the bucket and are
    compared there with the rest, so that a group of copies costs each member once for each straggler, not for each other.
    """
    spark = met.sparkSession
    open_ = met.select("band", "node").join(centres.select("band", F.col("_node").alias("node")), ["band", "node"], "left_anti").join(
        roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = materialised(open_, "open")
    parts = open_.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = materialised(parts.groupBy("band").agg(
        F.max_by("root", "n").alias("_main"), F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_roots")).filter("_roots > 1"), "mixed")
    dealt = open_.join(mixed, "band").select(
        "band", "node", "root", (F.col("root") != F.col("_main")).alias("asks"), F.ceil(F.col("_n") / SLICE).alias("_slices")).withColumn(
        "_home", F.pmod(F.xxhash64("node"), F.col("_slices")))
    asking = dealt.filter("asks").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1)))
    dealt = dealt.filter("not asks").withColumn("slice", F.col("_home")).unionByName(asking).select(
        "band", "slice", "node", "root", "asks", (F.col("slice") == F.col("_home")).alias("home"))
    dealt = materialised(dealt, "dealt")
    if dealt.isEmpty():
        return spark.createDataFrame([], "a long, b long")
    full = dealt.join(nodes.select("node", "size", "bands"), "node").join(sets, "node").withColumn(
        "place", F.array_position(F.col("bands"), F.col("band")) - 1)
    found = full.groupBy("band", "slice").applyInArrow(compared(percent), "a long, b long")
    return materialised(found.distinct(), "more")


def jaccard_groups(docs: DataFrame, key: Column, shingle: int = SHINGLE, percent: int = PERCENT, simhash: bool = False) -> DataFrame:
    """``key``, ``size`` (of the set of shingles) and ``root`` of every row; rows of one root are linked, if through others.

    Two texts are linked if their sets of word shingles share ``percent`` percent of their union or more.  Equal sets are
    one node.  Nodes that agree in a band meet in its bucket.  Every bucket compares its members with its centre; members
    that are still of several components then are compared with each other (:func:`_left_over`), so large groups of
    copies take few pairs and no link is lost.  Pairs whose sizes or sketches rule the similarity out are left out;
    the rest is verified on the full sets.  Sets without a shingle are one node without
    links.  Null texts count as empty, repeated rows come back as often as they came, no rows give no rows.

    With ``simhash`` the sets are linked by their fingerprints first (:func:`by_fingerprint`), confirmed on the full sets;
    the bands then compare only nodes that these links have not brought together.
    """
    # Ids may be null or come with several texts, so a text is found again by its id and hash.
    rows = docs.select(key.alias("key"), F.struct(key.alias("key"), F.xxhash64(text_of()).alias("hash")).alias("at"), text_of().alias("text"))
    prints = materialised(per_text(rows, "digest binary, size long, bands array<long>, sketch binary" + (", bits long" if simhash else ""),
                                   prints_of(shingle, simhash)), "prints")
    # Numbers are given while the table is written, so every later read sees the same.
    nodes = materialised(prints.groupBy("digest").agg(
        F.min("at").alias("at"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        *([F.first("bits").alias("bits")] if simhash else []),
    ).withColumn("node", F.monotonically_increasing_id()), "nodes")

    bands = nodes.select("node", "size", F.explode("bands").alias("band"))
    shared = materialised(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band"), "shared")
    met = may_hold(bands, F.col("band"), shared, F.col("band")).join(shared.hint("merge"), "band")
    met = materialised(met.withColumn("turn", F.struct(F.xxhash64("node").alias("hash"), F.col("node").alias("node"), F.col("size").alias("size"))), "met")
    members = met.select("node")
    if simhash:
        close = materialised(_sketched(by_fingerprint(nodes, percent), nodes, percent), "close")
        members = members.unionAll(close.select("a")).unionAll(close.select("b"))
    wanted = materialised(members.distinct().join(nodes.select("node", "at"), "node"), "wanted")
    texts = may_hold(rows.select("at", "text"), F.xxhash64("at"), wanted, F.xxhash64("at")).join(wanted, "at").dropDuplicates(["node"])
    sets = materialised(per_text(texts.select("node", "text"), "members array<long>", lambda found: [
        pa.array([shingles(t, shingle).view(np.int64) for t in found.to_pylist()], pa.list_(pa.int64()))]), "sets")

    # The centre of a bucket is its first member in an order that is the same for all buckets.
    centres = materialised(met.groupBy("band").agg(F.min("turn").alias("centre")).select(
        "band", F.col("centre.node").alias("_node"), F.col("centre.size").alias("_size")), "centres")
    pairs = met.join(centres, "band").filter((F.col("node") != F.col("_node")) & _fits("size", "_size", percent)).select(
        F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()
    if simhash:
        near = materialised(_verified(close, sets, percent), "near")
        pairs = _apart(pairs, materialised(least_reachable(near), "roots"))
    pairs = materialised(_sketched(pairs, nodes, percent), "pairs")
    links = _verified(pairs, sets, percent)
    links = materialised(links.unionAll(near) if simhash else links, "links")
    roots = materialised(least_reachable(links), "roots")
    more = _left_over(met, centres, roots, nodes, sets, percent)
    if not more.isEmpty():
        roots = materialised(least_reachable(links.unionAll(more)), "roots")
    rooted = nodes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    return prints.select("key", "size", "digest").join(rooted, "digest").drop("digest")


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a shingle are linked with nothing; rows without an id name no component and are not kept."""
    groups = materialised(jaccard_groups(table(spark, sf_dir, "documents"), F.col("doc_id")), "groups")
    names = groups.filter("size > 0").groupBy("root").agg(F.min("key").alias("component_id"))
    linked = groups.filter("size > 0").join(names, "root").drop("root")
    alone = groups.filter("size = 0").select("key", "size", F.col("key").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("key").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept"))


#: Pairs meet under a shared shingle and are counted there; links are followed to the least document.
OP12_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) = 1 THEN words
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles
  FROM worded
), sized AS (
  SELECT doc_id, len(shingles) AS n, shingles FROM sets
), kinds AS (
  SELECT min(doc_id) AS least, any_value(n) AS n, list_sort(shingles) AS shingles, list(doc_id) AS ids
  FROM sized WHERE n > 0 GROUP BY list_sort(shingles)
), members AS (
  SELECT least, n, unnest(shingles) AS shingle FROM kinds
), pairs AS (
  SELECT a.least AS a, b.least AS b, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS shared
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.least < b.least
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.least, b.least
), links AS (
  SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (m + n - shared)
), turned AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT least AS node, least AS seen FROM kinds
  UNION
  SELECT r.node, e.b FROM reach r JOIN turned e ON r.seen = e.a
), roots AS (
  SELECT node, min(seen) AS root FROM reach GROUP BY node
), named AS (
  SELECT unnest(k.ids) AS doc_id, r.root AS component_id FROM kinds k JOIN roots r ON k.least = r.node
)
SELECT s.doc_id, s.n AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id,
  s.doc_id = coalesce(m.component_id, s.doc_id) AS kept
FROM sized s LEFT JOIN named m ON s.doc_id = m.doc_id
"""
