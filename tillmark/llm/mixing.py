"""Mixing sources to target weights by subset sums over token lengths."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.functions.ordering import attach
from tillmark.llm.common import WORD, ship, table, text_of
from tillmark.session import materialised

ship(sys.modules[__name__])

#: Weights of the sources in code-point order, repeating; what the mix holds in units of all words; copies of a document at most.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
COPIES = 2
SEED = 42
#: The last words of a budget are fitted exactly by dynamic programming; before that the same share of all lengths is taken.
FIT = 8192
#: Sums of more words are scaled down to about so many.
BITS = 1 << 16
#: Documents of one source and length are ranked in buckets of about this many.
BUCKET = 10_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from one row per source (``source``, ``source_size``).

    Sources in code-point order, null last, take the weights in turn and share
    ``share`` of all words by them.  A target stops at ``copies`` times its source; the
    excess is shared again among the rest by weight.  In the end all targets below
    their limit stand at the same height above their weight, and a source is at its
    limit if its limit over its weight is below that height: so the height follows
    from running sums over the sources ordered by that ratio.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    every = Window.partitionBy(F.lit(0))
    filled = (
        sizes.select("source", F.col("source_size").cast("long").alias("source_size"))
        .withColumn("weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * F.lit(float(copies)))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
    )
    below = Window.orderBy("ratio", "source").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "source").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = (
        filled.withColumn("height", (F.col("budget") - F.coalesce(F.sum("limit").over(below), F.lit(0.0))) / F.sum("weight").over(rest))
        # The first source in this order whose limit is not reached gives the height; without one all are full.
        .withColumn("height", F.min(F.when(F.col("ratio") >= F.col("height"), F.struct("ratio", "source", "height"))).over(every)["height"])
    )
    return filled.select("source", "source_size", F.when(F.col("height").isNull(), F.col("limit")).otherwise(
        F.least("limit", F.col("weight") * F.col("height"))).alias("target"))


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, fit: int = FIT, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that their words come closely to ``budget`` from below.

    Documents first are taken with the same share along all lengths: the share's running total over the lengths is rounded,
    from a seeded start, and its steps are taken, so that lengths of few documents take part in proportion.
    The share leaves a reserve of half of ``fit`` words, at most an eighth of the budget.  What is open above the
    reserve, by lengths that don't come out even, is shared out in the same way over the words that are left.
    The reserve is filled by bounded-knapsack dynamic programming: the sums that can be reached are the bits of an
    integer; counts are split into powers of two.  Where all lengths are large ``fit`` grows with the shortest, and
    the sums are scaled.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    budget = min(budget, total)
    take = np.zeros_like(counts)
    if budget <= 0:
        return take
    if budget == total:
        return counts
    draw = np.random.default_rng(seed)
    start = draw.random()
    fit = max(fit, 8 * int(lengths[(lengths > 0) & (counts > 0)].min()))
    reserve = min(fit // 2, budget // 8)
    ascending = np.argsort(lengths, kind="stable")
    below = np.cumsum(counts[ascending])
    words = budget - reserve
    while words > 0:
        take[ascending] = np.diff(np.floor(below * (words / total) + start).astype(np.int64), prepend=0)
        over = int((take * lengths).sum()) - (budget - reserve)
        if over <= 0:
            break
        take[:] = 0  # a longest document too many: a little less of all
        words -= max(over, reserve // 4, 1)
    left = budget - int((take * lengths).sum())
    while left >= max(fit, 2 * reserve):
        gap = left - reserve
        spare = np.where((lengths > 0) & (lengths <= gap), counts - take, 0)
        open_words = int((spare * lengths).sum())
        if not open_words:
            break
        take += _spread(lengths, spare, min(gap, open_words), open_words)
        left = budget - int((take * lengths).sum())
    # Now the open words are few, or only documents of about as many words are left, of which no two fit.
    unit = max(1, left // BITS)
    order = draw.permutation(len(lengths))
    if left >= fit:
        fitting = np.where((counts > take) & (lengths <= left), lengths, 0)
        if fitting.max() > 0:
            take[fitting.argmax()] += 1
    else:
        size_of = -(-lengths // unit)
        take += _filled(size_of, counts - take, left // unit, order)
    if unit > 1 or left >= fit:  # what scaled sums leave open
        left = budget - int((take * lengths).sum())
        for i in np.argsort(-lengths, kind="stable"):
            more = min(int(counts[i] - take[i]), left // int(lengths[i])) if lengths[i] > 0 else 0
            take[i] += more
            left -= more * int(lengths[i])
    return take


def _spread(lengths: np.ndarray, counts: np.ndarray, words: int, total: int) -> np.ndarray:
    """About ``words`` of the ``total`` words, not more, from the longest down: at no length more than the share of those so far."""
    take, seen, taken = np.zeros_like(counts), 0, 0
    for i in np.argsort(-lengths, kind="stable"):
        if counts[i] > 0:
            seen += int(lengths[i] * counts[i])
            take[i] = min(int(counts[i]), (seen * words // total - taken) // int(lengths[i]))
            taken += int(take[i] * lengths[i])
    return take


def _filled(lengths: np.ndarray, counts: np.ndarray, left: int, order: np.ndarray) -> np.ndarray:
    """The choice of at most ``counts`` whose sum is the largest up to ``left``."""
    take = np.zeros_like(counts)
    items = [(i, size) for i in order if 0 < lengths[i] <= left for size in _powers(int(counts[i]), left // int(lengths[i]))]
    reached, mask, history = 1, (1 << (left + 1)) - 1, []
    for i, size in items:
        history.append(reached)
        reached |= (reached << (size * int(lengths[i]))) & mask
        if reached >> left & 1:
            break
    at = reached.bit_length() - 1
    for (i, size), before in zip(reversed(items[:len(history)]), reversed(history), strict=True):
        if not before >> at & 1:
            take[i] += size
            at -= size * int(lengths[i])
    return take


def _powers(count: int, most: int) -> list[int]:
    """Numbers whose partial sums are 0 to min(count, most)."""
    count, parts = min(count, most), []
    while count > 0:
        parts.append(min(count, 1 << len(parts)))
        count -= parts[-1]
    return parts


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, copies: int = COPIES,
        seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``copies`` (0 and more) of every row of ``docs``.

    The columns named by ``carry`` come along.

    All documents of a source are taken as often as its target holds the whole source;
    the rest of the target is a choice of documents whose sizes sum up to just below it.
    Documents are counted by exact size; the counts and the seed decide how many of each
    size are taken, and a seeded hash of the id which.  The result is the same in every run.

    Null texts have size 0; documents of size 0 are taken with the whole source only.
    A null source is a source.  Repeated rows are rows of their own (of rows with one id, any may be
    chosen); other columns are ignored; no rows give no rows.
    """
    sized = materialised(docs.select(
        "doc_id", "source", word_count(text_of()).alias("size"), F.xxhash64(F.lit(seed), "doc_id").alias("draw"),
        *carry), "sizes")
    lengths = materialised(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    plan = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, copies)
    plan = materialised(plan.withColumn("whole", F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.col("source_size") + F.lit(1e-9)), F.lit(copies))).otherwise(F.lit(1)).cast("int")), "targets")

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        source_size, target, whole = frame[["source_size", "target", "whole"]].iloc[0]
        budget = int(round(target - source_size * whole)) if whole < copies else 0
        frame = frame.sort_values("size")
        frame["extra"] = fit_lengths(frame["size"].to_numpy(), frame["n"].to_numpy(), budget, seed=seed)
        return frame[["source", "size", "n", "extra", "source_size", "target", "whole"]]

    kind = docs.schema["source"].dataType.simpleString()
    # One row per length and source: a group is bounded by the number of different lengths.
    chosen = materialised(attach(lengths, plan, ["source"]).groupBy("source").applyInPandas(
        choose, f"source {kind}, size long, n long, extra long, source_size long, target double, whole int"), "chosen")

    # Which documents: the first ones by hash.  Hashes fall into as many ranges as there are BUCKETs in a length, so
    # that no window sees all documents of a frequent length.
    bucketed = attach(sized, chosen, ["source", "size"]).withColumn("ranges", F.expr(f"1 + n div {BUCKET}")).withColumn(
        "range", F.floor((F.col("draw").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)) * F.col("ranges")).cast("long"))
    partly = bucketed.filter("extra > 0 and extra < n")
    key = ["source", "size", "range"]
    earlier = Window.partitionBy("source", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = partly.groupBy(*key).agg(F.count(F.lit(1)).alias("_c")).withColumn(
        "before", F.coalesce(F.sum("_c").over(earlier), F.lit(0))).drop("_c")
    place = F.row_number().over(Window.partitionBy(*key).orderBy("draw", "doc_id"))
    drawn = attach(partly.withColumn("place", place), before, key).withColumn(
        "more", (F.col("before") + F.col("place") <= F.col("extra")).cast("int"))
    certain = bucketed.filter("extra = 0 or extra = n").withColumn("more", (F.col("extra") > 0).cast("int"))
    out = ["doc_id", "source", "size", "source_size", "target", (F.col("whole") + F.col("more")).alias("copies"), *carry]
    return certain.select(*out).unionAll(drawn.select(*out))


def repeat_to_weights(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows that agree in id, source and text stand for each other: the first one found is
    repeated as often as all of them are taken.
    """
    key = F.struct("doc_id", "source", F.sha2(text_of(), 256).alias("sha")).alias("_key")
    taken = mix(docs.select("doc_id", "source", "text", key), carry=["_key"], **options).groupBy("_key").agg(
        F.sum("copies").cast("int").alias("_copies")).filter("_copies > 0")
    rows = docs.select(key, F.struct("*").alias("_row")).join(taken, "_key").dropDuplicates(["_key"])
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")
