"""Windows over a time series.

Only for rows already summed to one per day (or week): then a window partition
holds at most as many rows as the calendar has days, whatever the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tillmark.functions.numbers import sample_std, squared

EPOCH = "1970-01-01"


def by_row(keys: Sequence[str], day: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(day)


def by_day(keys: Sequence[str], day: str) -> WindowSpec:
    """Ordered by day number, for frames measured in days rather than rows."""
    return Window.partitionBy(*keys).orderBy(F.datediff(F.col(day), F.lit(EPOCH).cast("date")))


def lagged(value: str, steps: int, keys: Sequence[str], day: str, mode: str = "rows") -> Column:
    """The value ``steps`` rows back, or exactly ``steps`` days back."""
    if mode == "rows":
        return F.lag(value, steps).over(by_row(keys, day))
    return F.max(value).over(by_day(keys, day).rangeBetween(-steps, -steps))


def frame(steps: int, keys: Sequence[str], day: str, mode: str = "rows", include_current: bool = False) -> WindowSpec:
    """The trailing ``steps`` rows (or days), with or without the current one."""
    first, last = (1 - steps, 0) if include_current else (-steps, -1)
    if mode == "rows":
        return by_row(keys, day).rowsBetween(first, last)
    return by_day(keys, day).rangeBetween(first, last)


def trailing_mean(value: str, over: WindowSpec, min_periods: int = 1) -> Column:
    mean = F.avg(value).over(over)
    return mean if min_periods <= 1 else F.when(F.count(value).over(over) >= min_periods, mean)


def trailing_std(value: str, over: WindowSpec) -> Column:
    amount = F.col(value).cast("long")
    return sample_std(F.count(amount).over(over), F.sum(amount).over(over), F.sum(squared(amount)).over(over))
