"""A Merkle manifest of documents: a tree per language, a tree over their roots, and a proof for every row."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillmark.functions.ordering import running_total
from tillmark.llm.common import ship, table
from tillmark.session import materialised

ship(sys.modules[__name__])

#: A partition of leaves is a run of 2 ** HEIGHT neighbours; it bounds the rows of a task, however large a tree.
HEIGHT = 12
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: One row in this many ids is changed by the query's tampering.
TAMPERED = 7

Node = tuple[int, int]


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    written = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))


def digest_of(**changed: Column) -> Column:
    """The leaf of a row as 32 bytes, with other values for some of its fields."""
    return F.unhex(F.sha2(F.concat(*[framed(changed.get(f, F.col(f))) for f in FIELDS]).cast("binary"), 256))


def parent(nodes: list[bytes]) -> bytes:
    """The digest of a run of nodes: of their hex texts, one after the other."""
    return hashlib.sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def missing(places: np.ndarray, count: int) -> list[Node]:
    """Level and index of the nodes that the proofs of all the leaves at ``places`` need and can't derive from them.

    This is the least union: a sibling counts only if no leaf of the set is under it, and once for all leaves.
    """
    found, level, own = [], 0, np.unique(places)
    while count > 1:
        beside = own ^ 1
        beside = beside[(beside < count) & ~np.isin(beside, own)]
        found += [(level, int(i)) for i in beside]
        own, count, level = np.unique(own >> 1), (count + 1) // 2, level + 1
    return found


def climb(own: dict[int, bytes], count: int, fetched: dict[Node, bytes], levels: int | None = None) -> list[dict[int, bytes]]:
    """The nodes by index on every level from the leaves up, as far as the leaves and the fetched nodes tell them."""
    all_levels, level = [], 0
    while True:
        here = {**own, **{i: d for (at, i), d in fetched.items() if at == level}}
        all_levels.append(here)
        if count <= 1 or level == levels:
            return all_levels
        own = {i: parent([here[j] for j in (2 * i, 2 * i + 1) if j < count]) for i in sorted({i >> 1 for i in own})}
        count, level = (count + 1) // 2, level + 1


PART = "tree string, run long, level int, place long, digest binary, wanted boolean"


def _summits(height: int):
    """Per run of leaves its topmost node, and the coordinates of the nodes its proofs lack."""
    def run(key: tuple, leaves: pa.Table) -> pa.Table:
        places, count = leaves.column("place").to_numpy(), leaves.column("count")[0].as_py()
        at = key[1].as_py()
        own = dict(zip(places.tolist(), leaves.column("digest").to_pylist(), strict=True))
        tops = climb(own, count, {}, height)
        wanted = missing(places, count)
        level = len(tops) - 1
        rows = [(level, i, d, False) for i, d in tops[-1].items()] + [(*n, None, True) for n in wanted]
        return pa.table({
            "tree": pa.array([key[0].as_py()] * len(rows), pa.string()), "run": pa.array([at] * len(rows), pa.int64()),
            "level": pa.array([r[0] for r in rows], pa.int32()), "place": pa.array([r[1] for r in rows], pa.int64()),
            "digest": pa.array([r[2] for r in rows], pa.binary()), "wanted": pa.array([r[3] for r in rows], pa.bool_())})

    return run


def _interior(height: int):
    """All nodes from the given ones of a run up to its topmost one."""
    def run(key: tuple, leaves: pa.Table) -> pa.Table:
        base = leaves.column("level")[0].as_py()
        own = dict(zip(leaves.column("place").to_pylist(), leaves.column("digest").to_pylist(), strict=True))
        rows = [(base + n, i, d) for n, nodes in enumerate(climb(own, leaves.column("count")[0].as_py(), {}, height))
                for i, d in nodes.items()]
        return pa.table({
            "tree": pa.array([key[0].as_py()] * len(rows), pa.string()), "level": pa.array([r[0] for r in rows], pa.int32()),
            "place": pa.array([r[1] for r in rows], pa.int64()), "digest": pa.array([r[2] for r in rows], pa.binary())})

    return run


PROOF = "proof array<struct<digest: binary, before: boolean>>, top binary"


def _prove(carry: pa.Schema):
    """Proofs of all leaves of a run from its leaves and the nodes fetched for it: an entry for each level."""
    def run(leaves: pa.Table, fetched: pa.Table) -> Iterator[pa.Table] | pa.Table:
        places, count = leaves.column("place").to_numpy(), leaves.column("count")[0].as_py()
        own = dict(zip(places.tolist(), leaves.column("digest").to_pylist(), strict=True))
        got = {(r["level"], r["place"]): r["digest"] for r in fetched.to_pylist()}
        levels = climb(own, count, got)
        digests, before = [], []
        for level, nodes in enumerate(levels[:-1]):
            index = np.fromiter(nodes, dtype=np.int64)
            order = np.argsort(index)
            beside = (places >> level) ^ 1
            at = np.minimum(np.searchsorted(index[order], beside), len(index) - 1)
            there = index[order][at] == beside
            kept = pa.array(list(nodes.values()), pa.binary())
            digests.append(kept.take(pa.array(order[at], mask=~there)))
            before.append(pa.array(beside < (places >> level), mask=~there))
        depth, n = len(digests), len(places)
        turn = pa.array((np.arange(n)[:, None] + np.arange(depth)[None, :] * n).ravel()) if depth else pa.array([], pa.int64())
        entries = pa.StructArray.from_arrays(
            [pa.concat_arrays(digests).take(turn) if depth else pa.array([], pa.binary()),
             pa.concat_arrays(before).take(turn) if depth else pa.array([], pa.bool_())], ["digest", "before"])
        proofs = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * depth), entries)
        columns = {name: leaves.column(name).combine_chunks() for name in carry}
        top = next(iter(levels[-1].values()))
        return pa.table({**columns, "proof": proofs, "top": pa.array([top] * n, pa.binary())})

    return run


def proven(leaves: DataFrame, carry: list[str], height: int = HEIGHT) -> DataFrame:
    """``carry``, ``tree``, ``place``, ``digest``, ``proof`` and ``top`` (the root of the tree) of every leaf.

    ``leaves`` has tree, place (0, 1, ... within the tree), count (leaves of the tree) and digest.  Each run of
    2 ** height leaves of a tree is folded in its task, which also works out the least union of nodes all its
    proofs lack.  What lies above the runs is folded in the same way, one node per run, until a tree is one node.
    The nodes a run lacks are then fetched by one join, at most one per level, and the run derives the interior
    nodes its leaves share and lays out the proof of each.  Proofs have an entry per level: the sibling, null if
    there is none, and whether it comes before.
    """
    spark = leaves.sparkSession
    leaves = leaves.withColumn("run", F.shiftright("place", height))
    parts = materialised(
        leaves.select("tree", "run", "place", "count", "digest").groupBy("tree", "run").applyInArrow(_summits(height), PART), "summits")
    counts = leaves.groupBy("tree").agg(F.max("count").alias("count"))
    # Only trees of several runs have nodes above them.
    level = height
    nodes = spark.createDataFrame([], "tree string, level int, place long, digest binary")
    current = parts.filter("not wanted").select("tree", "level", "place", "digest")
    width = counts.select("tree", F.shiftright(F.col("count") + F.lit((1 << height) - 1), height).alias("count")).filter("count > 1")
    while not width.isEmpty():
        here = current.filter(F.col("level") == level).join(width, "tree").withColumn("run", F.shiftright("place", height))
        above = materialised(here.groupBy("tree", "run").applyInArrow(
            _interior(height), "tree string, level int, place long, digest binary"), "interior")
        nodes = nodes.unionAll(above.filter(F.col("level") < level + height))
        current, level = above, level + height
        width = width.select("tree", F.shiftright(F.col("count") + F.lit((1 << height) - 1), height).alias("count")).filter("count > 1")
    nodes = nodes.dropDuplicates(["tree", "level", "place"])
    fetched = parts.filter("wanted").select("tree", "run", "level", "place").join(nodes, ["tree", "level", "place"]).select(
        "tree", "run", "level", "place", "digest")
    columns = list(dict.fromkeys(["tree", "place", "digest", *carry]))
    picked = leaves.select("run", "count", *columns)
    schema = StructType([*leaves.select(*columns).schema, *StructType.fromDDL(PROOF)])
    return picked.groupBy("tree", "run").cogroup(fetched.groupBy("tree", "run")).applyInArrow(_prove(columns), schema)


def _placed(rows: DataFrame, order: list[Column], groups: list[str]) -> DataFrame:
    """``rows`` with their place in the group and its size, numbered in slices."""
    counted = running_total(rows.withColumn("_one", F.lit(1).cast("long")), order, "_one", alias="_n", groups=groups, total="count")
    return counted.withColumn("place", F.col("_n") - 1).drop("_n", "_one")


def manifest(docs: DataFrame, height: int = HEIGHT, **also: Column) -> DataFrame:
    """The Merkle manifest of documents: one row per document, repeated ones too.

    Columns: doc_id, lang, ``place`` (its number among the leaves of its language), ``leaf``, ``subroot``, ``root``
    (binary) and ``proof``, an array with an entry per level up to the root: the sibling's digest, null where a node
    has none, and whether it comes before.  ``also`` names digests to carry along, such as :func:`digest_of` a changed row.

    A leaf is the SHA-256 of doc_id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 length, a
    colon and itself.  Leaves of a language ascend by doc_id, null first; rows of one id by their digest, so that
    repeated rows have equal leaves in neighbouring places.  Two consecutive nodes become the digest of their hex
    texts, a last single one the digest of its own, until one is left; languages, null first, then bytewise,
    form the upper tree.  Empty texts are values; texts of any length are hashed where they are read and not
    shuffled; other columns are ignored; no rows give no rows.
    """
    tree = framed(F.col("lang")).alias("tree")
    rows = docs.select("doc_id", "lang", tree, digest_of().alias("digest"), *[c.alias(n) for n, c in also.items()])
    leaves = materialised(_placed(rows, [F.col("doc_id").asc_nulls_first(), F.col("digest")], ["tree"]), "leaves")
    lower = materialised(proven(leaves, ["doc_id", "lang", *also], height), "proofs")
    # One row per language: the proofs of a run agree in it.
    subroots = lower.groupBy("tree").agg(F.first("lang").alias("lang"), F.first("top").alias("digest"))
    subroots = materialised(_placed(subroots.select("lang", F.col("tree").alias("name"), F.lit("langs").alias("tree"), "digest"),
                                    [F.col("lang").asc_nulls_first()], ["tree"]), "subroots")
    upper = materialised(proven(subroots, ["name"], height).select(
        F.col("name").alias("tree"), F.col("proof").alias("above"), F.col("top").alias("root")), "upper")
    return lower.join(upper, "tree").select(
        "doc_id", "lang", "place", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root",
        F.concat("proof", "above").alias("proof"), *also)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to, as lowercase hex."""
    def step(node: Column, entry: Column) -> Column:
        other = F.coalesce(F.lower(F.hex(entry["digest"])), F.lit(""))
        return F.sha2(F.when(entry["before"], F.concat(other, node)).otherwise(F.concat(node, other)).cast("binary"), 256)

    return F.aggregate(proof, F.lower(F.hex(leaf)), step)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0) & F.col("n_chars").isNotNull()
    longer = digest_of(n_chars=F.col("n_chars").cast("decimal(20,0)") + 1)
    rows = manifest(docs, tampered=F.when(changed, longer))
    shown = lambda c: F.lower(F.hex(c))
    siblings = F.array_join(F.transform("proof", lambda e: F.lower(F.hex(e["digest"]))), "")
    root = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select(
        "doc_id", shown("leaf").alias("leaf"), shown("subroot").alias("subroot"), shown("root").alias("root"),
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), root.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


#: CRC-32 bit by bit, as DuckDB has no such function; nodes level by level; proofs and folds along each path.
OP13_SQL = """
WITH RECURSIVE framed AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS size,
    coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1)::VARCHAR, '-') AS longer,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    list_reduce(
      list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
      lambda crc, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[],
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, xor(crc, byte)),
      4294967295::UBIGINT) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || size || body) AS leaf,
    CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 AND n_chars IS NOT NULL THEN sha256(head || longer || body) END AS tampered
  FROM framed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY lang) AS width FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(width) + 1) // 2
  FROM nodes WHERE width > 1 GROUP BY lang, level, place // 2
), subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE width = 1
), tops AS (
  SELECT 0 AS level, place, digest, count(*) OVER () AS width FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(width) + 1) // 2
  FROM tops WHERE width > 1 GROUP BY level, place // 2
), heights AS (
  SELECT n.lang, n.level AS height, s.place AS spot, s.digest AS subroot
  FROM nodes n JOIN subroots s ON n.lang IS NOT DISTINCT FROM s.lang WHERE n.width = 1
), steps AS (
  SELECT p.lang, p.place, n.level, n.place < (p.place >> n.level) AS before, n.digest AS sibling
  FROM placed p JOIN (SELECT DISTINCT lang, level FROM nodes WHERE width > 1) l ON p.lang IS NOT DISTINCT FROM l.lang
  JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.level = l.level AND n.place = xor(p.place >> l.level, 1)
  UNION ALL
  SELECT p.lang, p.place, h.height + t.level, t.place < (h.spot >> t.level), t.digest
  FROM placed p JOIN heights h ON p.lang IS NOT DISTINCT FROM h.lang
  JOIN (SELECT DISTINCT level FROM tops WHERE width > 1) l ON true
  JOIN tops t ON t.level = l.level AND t.place = xor(h.spot >> l.level, 1)
), proofs AS (
  SELECT p.lang, p.place, sha256(coalesce(string_agg(s.sibling, '' ORDER BY s.level), '')) AS proof_sha256
  FROM placed p LEFT JOIN steps s ON p.lang IS NOT DISTINCT FROM s.lang AND p.place = s.place GROUP BY p.lang, p.place
), climbs AS (
  SELECT p.lang, p.place, 0 AS level, h.height + (SELECT max(level) FROM tops) AS last, coalesce(tampered, leaf) AS digest
  FROM placed p JOIN heights h ON p.lang IS NOT DISTINCT FROM h.lang
  UNION ALL
  SELECT c.lang, c.place, c.level + 1, c.last,
    sha256(CASE WHEN s.before THEN s.sibling || c.digest ELSE c.digest || coalesce(s.sibling, '') END)
  FROM climbs c LEFT JOIN steps s ON c.lang IS NOT DISTINCT FROM s.lang AND c.place = s.place AND c.level = s.level
  WHERE c.level < c.last
)
SELECT p.doc_id, p.leaf, h.subroot, t.digest AS root, f.proof_sha256, c.digest AS folded_root, c.digest = t.digest AS verified
FROM placed p
JOIN heights h ON p.lang IS NOT DISTINCT FROM h.lang
JOIN proofs f ON p.lang IS NOT DISTINCT FROM f.lang AND p.place = f.place
JOIN climbs c ON p.lang IS NOT DISTINCT FROM c.lang AND p.place = c.place AND c.level = c.last
CROSS JOIN (SELECT digest FROM tops WHERE width = 1) t
"""
