"""Money, guarded ratios and spread, all exact until the last step.

Stored money is decimal(12,2).  Sums run over whole cents instead: a long is added
in generated code, where a decimal sum builds an object per row.  Ratios are
rounded as decimals.  So a result never depends on the order in which tasks
happened to add things up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    return as_column(value).cast(MONEY)


def cents(value: Column | str) -> Column:
    """Decimal money as whole cents."""
    return (money(value) * F.lit(100)).cast("long")


def dollars(whole_cents: Column | str) -> Column:
    """Whole cents, usually a sum of them, as decimal money."""
    return (as_column(whole_cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def ratio(numerator: Column | str, denominator: Column | str, scale: int, factor: int = 1) -> Column:
    """round(factor * numerator / denominator, scale); null when the denominator is 0."""
    num = (as_column(numerator).cast("decimal(26,6)") * F.lit(factor)).cast("decimal(28,6)")
    den = as_column(denominator).cast("decimal(20,2)")
    return F.round(num / F.nullif(den, F.lit(0).cast("decimal(20,2)")), scale)


def pct_change(new: Column | str, old: Column | str, scale: int = 2) -> Column:
    return ratio(as_column(new) - as_column(old), old, scale, factor=100)


def dollars_per(whole_cents: Column | str, count: Column | str, scale: int = 2) -> Column:
    """Money per item, from cents and a count."""
    return ratio(whole_cents, as_column(count) * 100, scale)


def sample_std(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from whole-number moments; null below two values.

    Whole moments can be merged in any order, so retried tasks give the same bits.
    The moments are subtracted as decimals: large values near each other would
    cancel as doubles.
    """
    n, total, squares = (c.cast("decimal(38,0)") for c in (n, total, squares))
    spread = (n * squares - total * total).cast("double")
    count = n.cast("double")
    return F.when(n >= 2, F.sqrt(spread / (count * (count - 1))))


def squared(whole: Column | str) -> Column:
    """The square of a whole number, wide enough to be summed."""
    wide = as_column(whole).cast("decimal(19,0)")
    return (wide * wide).cast("decimal(38,0)")
