"""Hard negatives: wrong answers that score close to, but clearly below, the right ones, found through one-bit codes."""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillmark.llm.common import ship, sliced, table
from tillmark.session import materialised

ship(sys.modules[__name__])

SEED = 11
#: One-bit codes per row, each of what the ones before it leave, and the bit planes a query is written in.
LEVELS = 4
PLANES = 6
#: A cell of the search holds about so many rows and anchors at most; it bounds a task, not the search.
ROWS = 16_384
ANCHORS = 8_192
#: Pairs of a cell that are estimated at a time.
PAIRS = 1 << 19
#: The query: positives per anchor, negatives per positive, and percent of the positive's score they lie between.
POSITIVES = 5
NEGATIVES = 3
BAND = (50, 95)
EVERY = 50
LAST = np.iinfo(np.int64).max


#: The rotation last used in this process, by its dimension.
TURNS: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """A random rotation of ``dim`` dimensions, the same everywhere."""
    if dim not in TURNS:
        q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
        TURNS.clear()
        TURNS[dim] = q * np.where(np.diag(r) < 0, -1.0, 1.0)
    return TURNS[dim]


def packed(bits: np.ndarray) -> np.ndarray:
    """Booleans of the last axis as 64-bit words."""
    pad = -bits.shape[-1] % 64 or (64 if bits.shape[-1] == 0 else 0)
    wide = np.concatenate([bits, np.zeros((*bits.shape[:-1], pad), dtype=bool)], axis=-1)
    return np.packbits(wide, axis=-1, bitorder="little").view("<u8")


@dataclass
class Codes:
    """``words`` (row, level, word), ``scale`` (row, level), norms of what the codes leave and of what they say."""

    words: np.ndarray
    scale: np.ndarray
    left: np.ndarray
    said: np.ndarray

    def __getitem__(self, at) -> Codes:
        return Codes(self.words[at], self.scale[at], self.left[at], self.said[at])


def encoded(vectors: np.ndarray, levels: int = LEVELS) -> Codes:
    """One-bit codes of integer vectors: the signs of the rotated vector, and its alignment with them.

    A vector is the sum of its sign vectors, each scaled by its alignment, and a rest at right angles to the last.
    """
    turned = vectors.astype(np.float64) @ rotation(vectors.shape[1]).T
    rest, words, scale = turned.copy(), [], []
    for _ in range(levels):
        plus = rest >= 0
        align = np.abs(rest).mean(axis=1) if rest.shape[1] else np.zeros(len(rest))
        rest -= align[:, None] * np.where(plus, 1.0, -1.0)
        words.append(packed(plus))
        scale.append(align)
    return Codes(np.stack(words, 1), np.stack(scale, 1), np.linalg.norm(rest, axis=1), np.linalg.norm(turned - rest, axis=1))


def intervals(codes: Codes, queries: np.ndarray, planes: int = PLANES) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (row, query) between which the inner products of coded rows and integer queries surely lie.

    The rotated query is rounded to ``planes`` bits, so that its product with a sign vector is a sum of popcounts.
    What rounding loses is at most the norm of the rounding error times that of what the codes say; what the codes
    leave is at most its norm times the query's, both by the Cauchy-Schwarz inequality.
    """
    dim = queries.shape[1]
    turned = queries.astype(np.float64) @ rotation(dim).T
    most = 2 ** (planes - 1) - 1
    step = np.maximum(np.abs(turned).max(axis=1, initial=0.0), 1e-12) / most
    whole = np.rint(turned / step[:, None]).astype(np.int64)
    lost = np.linalg.norm(turned - whole * step[:, None], axis=1)
    shifted = whole + most
    bits = [packed((shifted >> b & 1).astype(bool)) for b in range(planes)]
    middle = np.zeros((len(codes.left), len(queries)))
    for level in range(codes.scale.shape[1]):
        words = codes.words[:, level]
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        inner = np.zeros(middle.shape, dtype=np.int32)
        for b, plane in enumerate(bits):
            for w in range(words.shape[1]):
                inner += np.bitwise_count(words[:, w, None] & plane[None, :, w]).astype(np.int32) << (b + 1)
        inner = inner - shifted.sum(axis=1)[None, :] - (most * (2 * ones - dim))[:, None]
        middle += codes.scale[:, level, None] * inner
    middle *= step[None, :]
    norms = np.linalg.norm(turned, axis=1)
    half = codes.left[:, None] * norms[None, :] + codes.said[:, None] * lost[None, :]
    half += 1e-9 * (codes.left + codes.said)[:, None] * norms[None, :] + 1e-6
    return middle - half, middle + half


@dataclass
class Side:
    """Rows of a cell as arrays."""

    id: np.ndarray
    unnamed: np.ndarray
    print: np.ndarray
    vectors: np.ndarray


def side(rows: pa.Table) -> Side:
    ids = rows.column("vec_id").combine_chunks()
    flat = rows.column("vector").combine_chunks()
    return Side(ids.fill_null(LAST).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
                rows.column("print").to_numpy(), flat.flatten().to_numpy().reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64))


def codes_of(rows: pa.Table) -> Codes:
    n = rows.num_rows
    words = np.frombuffer(b"".join(rows.column("words").to_pylist()), dtype="<u8").reshape(n, LEVELS, -1)
    scale = rows.column("scale").combine_chunks().flatten().to_numpy().reshape(n, LEVELS)
    return Codes(words, scale, rows.column("left").to_numpy(), rows.column("said").to_numpy())


def numbers(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The labels of both sides as integers that agree where the labels do."""
    both = pa.chunked_array([*rows.column("label").chunks, *anchors.column("label").chunks], pa.string()).combine_chunks()
    found = both.dictionary_encode().indices.to_numpy()
    return found[:rows.num_rows], found[rows.num_rows:]


def scores(rows: Side, anchors: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), dtype=np.int64)
    for at in range(0, len(i), PAIRS // 8):
        part = slice(at, at + PAIRS // 8)
        out[part] = np.einsum("ij,ij->i", rows.vectors[i[part]], anchors.vectors[j[part]])
    return out


def first(rows: Side, i: np.ndarray, j: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Which of the pairs are among the first ``most`` of their anchor j: by score, then id, then print."""
    order = np.lexsort((rows.print[i], rows.id[i], rows.unnamed[i], -score, j))
    grouped = j[order]
    start = np.searchsorted(grouped, grouped)
    return order[np.arange(len(order)) - start < most]


def positives_of(most: int):
    """Of each anchor of a cell, the first other rows of its label in the cell."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        left, right = side(rows), side(anchors)
        found: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            codes, (label, wanted) = codes_of(rows), numbers(rows, anchors)
            for value in np.unique(wanted):
                own, asked = np.flatnonzero(label == value), np.flatnonzero(wanted == value)
                for at in range(0, len(asked), max(1, PAIRS // max(1, len(own)))):
                    part = asked[at:at + max(1, PAIRS // max(1, len(own)))]
                    low, high = intervals(codes[own], right.vectors[part])
                    other = (left.id[own][:, None] != right.id[part][None, :]) | left.unnamed[own][:, None]
                    low, high = np.where(other, low, -np.inf), np.where(other, high, -np.inf)
                    keep = other
                    if len(own) > most:
                        keep = other & (high >= np.partition(low, len(own) - most, axis=0)[len(own) - most])
                    i, j = np.nonzero(keep)
                    score = scores(left, right, own[i], part[j])
                    kept = first(left, own[i], part[j], score, most)
                    found.append((own[i][kept], part[j][kept], score[kept]))
        i, j, score = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]).astype(np.int64) for k in range(3))
        return pa.table({
            "anchor_id": pa.array(right.id[j], pa.int64()), "anchor_print": pa.array(right.print[j], pa.int64()),
            "positive_id": pa.array(left.id[i], pa.int64(), mask=left.unnamed[i]),
            "positive_print": pa.array(left.print[i], pa.int64()), "positive_score": pa.array(score, pa.int64())})

    return run


def negatives_of(most: int, band: tuple[int, int]):
    """Of each anchor and positive of a cell, the first rows of another label whose score is in the band."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        left, right = side(rows), side(anchors)
        got = {name: [] for name in ("i", "j", "slot", "score")}
        goals = [[g["positive_score"] for g in goal] for goal in anchors.column("goals").to_pylist()]
        if rows.num_rows and anchors.num_rows:
            codes, (label, own) = codes_of(rows), numbers(rows, anchors)
            at_once = max(1, PAIRS // rows.num_rows)
            for at in range(0, anchors.num_rows, at_once):
                part = np.arange(at, min(at + at_once, anchors.num_rows))
                low, high = intervals(codes, right.vectors[part])
                other = label[:, None] != own[part][None, :]
                slots = max(len(goals[j]) for j in part)
                for slot in range(slots):
                    goal = np.array([goals[j][slot] if slot < len(goals[j]) else -1 for j in part], dtype=np.int64)
                    least, top = goal * (band[0] / 100) - 1e-6, goal * (band[1] / 100) + 1e-6
                    keep = other & (high >= least) & (low <= top) & (goal >= 0)
                    sure = np.where(other & (low >= least + 2e-6) & (high <= top - 2e-6), low, -np.inf)
                    if len(label) > most:
                        keep &= high >= np.partition(sure, len(label) - most, axis=0)[len(label) - most]
                    i, j = np.nonzero(keep)
                    score = scores(left, right, i, part[j])
                    fits = (band[0] * goal[j] <= 100 * score) & (100 * score <= band[1] * goal[j])
                    i, j, score = i[fits], j[fits], score[fits]
                    kept = first(left, i, j, score, most)
                    for name, values in (("i", i[kept]), ("j", part[j[kept]]), ("score", score[kept]), ("slot", np.full(len(kept), slot))):
                        got[name].append(values)
        i, j, slot, score = (np.concatenate(got[n] or [np.zeros(0, np.int64)]).astype(np.int64) for n in ("i", "j", "slot", "score"))
        return pa.table({
            "anchor_id": pa.array(right.id[j], pa.int64()), "anchor_print": pa.array(right.print[j], pa.int64()),
            "slot": pa.array(slot, pa.int32()), "negative_id": pa.array(left.id[i], pa.int64(), mask=left.unnamed[i]),
            "negative_print": pa.array(left.print[i], pa.int64()), "negative_score": pa.array(score, pa.int64())})

    return run


def coded(rows: DataFrame) -> DataFrame:
    """Rows with the one-bit codes of their vectors."""
    schema = StructType([*rows.schema, *StructType.fromDDL("words binary, scale array<double>, left double, said double")])

    def run(batches):
        for batch in sliced(batches, 4096):
            lists = batch.column("vector")
            lengths = lists.value_lengths().to_numpy()
            flat, starts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
            parts: list = [None] * batch.num_rows
            for dim in np.unique(lengths):  # vectors of one length at a time
                at = np.flatnonzero(lengths == dim)
                made = encoded(flat[starts[at][:, None] + np.arange(dim)[None, :]])
                for n, i in enumerate(at):
                    parts[i] = (made.words[n].tobytes(), made.scale[n], made.left[n], made.said[n])
            columns = list(zip(*parts, strict=True)) if parts else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(columns[0], pa.binary()), pa.array(list(columns[1]), pa.list_(pa.float64())),
                                              pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND,
    rows: int = ROWS, anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of all anchors.

    ``vectors`` has vec_id, label and vector (integers; their inner products must fit a long); ``anchor`` tells which
    rows are anchors.  Rows with a null label or vector, or a null component, take no part; other columns are
    ignored.  A row's score is its inner product with the anchor; higher ones come first, then smaller ids, null
    last.  Positives are the first other rows (rows of another id) of the anchor's label; negatives are the first rows of
    another label whose score lies between the ``band``'s percentages of the positive's.  Repeated rows count
    once; rows that share an id but differ each take part; vectors of different length never meet; anchors without a
    positive and positives without a negative give no row, nor does an anchor without an id; no rows give no rows.

    Rows and anchors are dealt into slices and blocks of bounded size, and each pair of a slice and a block is a cell of
    its own.  In a cell, intervals from popcounts of one-bit codes tell which pairs can be among the first; only
    these are scored, in integers.  The best of each cell are then merged, so the result is exact.
    """
    known = vectors.select("vec_id", F.col("label").cast("string").alias("label"), "vector", anchor.alias("anchor")).filter(
        F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(~F.exists("vector", lambda x: x.isNull()))
    known = known.withColumn("print", F.xxhash64("label", "vector")).withColumn("dim", F.size("vector")).dropDuplicates(
        ["vec_id", "label", "vector"])
    whole = materialised(coded(known), "codes")
    asked = whole.filter(F.col("anchor") & F.col("vec_id").isNotNull())
    count = whole.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("anchor") & F.col("vec_id").isNotNull()).alias("m")).first()
    slices, blocks = max(1, math.ceil(count.n / rows)), max(1, math.ceil(count.m / anchors))
    dealt = whole.select("vec_id", "label", "print", "dim", "vector", "words", "scale", "left", "said").withColumn(
        "slice", F.pmod(F.xxhash64("vec_id", "print"), F.lit(slices))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def cells(questions: DataFrame, function, schema: str) -> DataFrame:
        spread = questions.withColumn("block", F.pmod(F.xxhash64("print", "vec_id"), F.lit(blocks)).cast("int")).withColumn(
            "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
        return dealt.groupBy("dim", "slice", "block").cogroup(spread.groupBy("dim", "slice", "block")).applyInArrow(function, schema)

    def best(found: DataFrame, keys: list[str], kind: str, most: int) -> DataFrame:
        order = [F.col(f"{kind}_score").desc(), F.col(f"{kind}_id").asc_nulls_last(), F.col(f"{kind}_print")]
        return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= most)

    names = ["anchor_id", "anchor_print"]
    right = best(cells(asked.select("vec_id", "label", "print", "dim", "vector"), positives_of(positives),
                       "anchor_id long, anchor_print long, positive_id long, positive_print long, positive_score long"),
                 names, "positive", positives)
    goals = materialised(right.groupBy(*names).agg(F.array_sort(F.collect_list(
        F.struct("rank", "positive_id", "positive_score"))).alias("goals")), "goals")
    questions = materialised(asked.select("vec_id", "label", "print", "dim", "vector").join(
        goals, (F.col("vec_id") == F.col("anchor_id")) & (F.col("print") == F.col("anchor_print"))).drop(*names), "questions")
    wrong = best(cells(questions, negatives_of(negatives, band),
                       "anchor_id long, anchor_print long, slot int, negative_id long, negative_print long, negative_score long"),
                 [*names, "slot"], "negative", negatives)
    return wrong.join(goals, names).select(
        "anchor_id", F.col("goals")[F.col("slot")]["positive_id"].alias("positive_id"), "rank", "negative_id",
        F.col("goals")[F.col("slot")]["positive_score"].alias("positive_score"), "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components become floor(256 x); rows with a component that is null or not finite take no part."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    finite = rows.filter(F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False)))
    whole = finite.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * 256)).alias("vector"))
    return hard_negatives(whole, F.coalesce(F.col("vec_id") % EVERY == 0, F.lit(False)))


OP11_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id, r.label, list_inner_product(a.vector, r.vector)::BIGINT AS score
  FROM whole a JOIN whole r ON a.vec_id % 50 = 0 AND len(a.vector) = len(r.vector)
), positives AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE label = own AND vec_id IS DISTINCT FROM anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id NULLS LAST) <= 5
)
SELECT p.anchor_id, p.positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id NULLS LAST))::INTEGER AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.own
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id NULLS LAST) <= 3
"""
