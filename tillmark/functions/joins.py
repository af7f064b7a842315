"""Size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def known_bytes(df: DataFrame) -> int:
    """Spark's own size estimate; for a plain table scan that is the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's automatic broadcast threshold in bytes; -1 when it is switched off."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    return known_bytes(df) <= broadcast_limit(df)


def lookup(df: DataFrame, as_small_as: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if the table it has no more rows than is small enough.

    Spark multiplies sizes over joins, so it takes a dimension put together from
    small tables for a huge one, and would shuffle the facts to join it.  Above the
    threshold nothing is marked and the join is shuffled, with hot keys split.
    """
    return F.broadcast(df) if fits_broadcast(as_small_as) else df


def parts_of(stored: DataFrame, part_bytes: int = 8 << 20) -> int:
    """Parts that a stored table needs at ``part_bytes`` of its files each.

    Left to itself AQE sizes tasks by the bytes they read, and of narrow rows of numbers 64 MB took 1.3 GB, sorted for a
    join and hashed three times for a distinct count.
    """
    return max(1, -(-known_bytes(stored) // part_bytes))


def dealt(left: DataFrame, right: DataFrame, key: str, parts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join dealt by ``key`` into ``parts``, if more than one and ``right`` is too large to be broadcast.

    For keys with few rows each, under aggregations that include the key: AQE splits no hot key of dealt rows.
    """
    if parts <= 1 or fits_broadcast(right):
        return left, right
    return left.repartition(parts, key), right.repartition(parts, key)


def by_series(rows: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Rows dealt by series into ``parts``, if more than one, for windows over each series.

    Only for rows already summed to one per series and day or week, of which no series has many.
    """
    return rows.repartition(parts, *keys) if parts > 1 else rows
