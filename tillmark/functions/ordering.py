"""Running totals and ranks over groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.session import materialised


def null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality on all the names, null matching null; still a hash-join condition."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def attach(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe join that keeps the left copy of the key columns."""
    extra = [c for c in right.columns if c not in names]
    other = right.select(*[F.col(n).alias(f"_r_{n}") for n in names], *extra)
    on = reduce(lambda a, b: a & b, [left[n].eqNullSafe(other[f"_r_{n}"]) for n in names])
    return left.join(other, on, how).drop(*[f"_r_{n}" for n in names])


def running_total(
    df: DataFrame,
    order_by: Sequence[Column],
    value: str,
    alias: str = "running_total",
    groups: Sequence[str] = (),
    slices: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the group through each row.

    A window over a whole group would run in one task.  Instead the rows are
    range-partitioned into equal slices, each slice is summed, and a row's total
    is what the earlier slices hold plus a running sum inside its own slice.
    ``order_by`` must order rows uniquely within a group, so that slices are even.
    The sliced rows are written down first: both passes have to see the same slices.
    ``total`` names a column for the sum over the whole group, if wanted.
    """
    order = [F.col(g).asc() for g in groups] + list(order_by)
    # Without a number AQE merges neighbouring slices of small input, which keeps their order.
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    sliced = materialised(ranged.withColumn("_slice", F.spark_partition_id()))

    keys = [*groups, "_slice"]
    # One row per group and slice.
    earlier = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys).agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    )
    if total:
        offsets = offsets.withColumn(total, F.sum("_sum").over(Window.partitionBy(*groups)))
    inside = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        attach(sliced.withColumn("_within", F.sum(value).over(inside)), offsets.drop("_sum"), keys)
        .withColumn(alias, F.col("_before") + F.col("_within"))
        .drop("_slice", "_within", "_before")
    )


def rank_within(df: DataFrame, groups: Sequence[str], value: str, alias: str) -> DataFrame:
    """RANK() by descending ``value`` within each group, for all rows of any group.

    Ties share a rank, so the distinct values are ranked (one row per value, its
    ties counted) and the rank is joined back.
    """
    rows = materialised(df)
    levels = rows.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_ties"))
    ranked = (
        running_total(levels, [F.col(value).desc()], "_ties", alias="_through", groups=groups)
        .withColumn(alias, F.col("_through") - F.col("_ties") + 1)
        .drop("_through", "_ties")
    )
    return attach(rows, ranked, [*groups, value])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order_by``, ties settled by all other columns.

    Spark limits each key to one row per task before the shuffle
    (WindowGroupLimit), so a key with a third of all rows costs no more to ship
    than any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    window = Window.partitionBy(*keys).orderBy(*order_by, *rest)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def numbered_after(df: DataFrame, start: Column | int, order_by: Sequence[str], alias: str) -> DataFrame:
    """Consecutive numbers after ``start`` in the given order, without a single-task sort."""
    counted = running_total(
        df.withColumn("_one", F.lit(1).cast("long")), [F.col(c).asc() for c in order_by], "_one", alias="_n")
    return counted.withColumn(alias, F.col("_n") + F.lit(start)).drop("_n", "_one")
