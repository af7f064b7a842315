"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.session import materialised


def _towards_least(links: DataFrame, smaller_only: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them and itself.

    ``smaller_only`` looks at smaller neighbours (and moves the node as well),
    otherwise only larger neighbours are moved.
    """
    if smaller_only:
        around = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = around.join(least, "u")
    if smaller_only:
        moved = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        moved = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b").distinct()


def least_reachable(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node with a link.

    ``links`` has two comparable columns ``a`` and ``b`` without nulls; links to
    itself, repeated and turned links do not matter.  Rounds alternate between moving
    larger neighbours and smaller neighbours to the least one until nothing moves; the
    number of rounds grows with the logarithm of the number of nodes.  A node with very many links
    meets its least neighbour in a join whose hot key Spark splits.  Each round is
    written to the shared folder.
    """
    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = materialised(links.select("a", "b").filter("a != b").distinct(), "links")
    before = None
    while (now := state(current)) != before:
        before = now
        current = materialised(_towards_least(_towards_least(current, False), True), "links")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
