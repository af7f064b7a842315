"""Approximate distinct counts that can be stored and united (HyperLogLog)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 ** LG_K registers: 4 kB a sketch, a relative standard error of 1.04 / sqrt(4096), 1.6 percent.
LG_K = 12


def with_sketch(rows: DataFrame, keys: Sequence[str], column: str, alias: str, lg_k: int = LG_K) -> DataFrame:
    """Per key a sketch of the distinct values of the column; nulls do not count."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(column, F.lit(lg_k)).alias(alias))


def united(sketches: DataFrame, keys: Sequence[str | Column], sketch: str, alias: str) -> DataFrame:
    """The distinct count per coarser key from stored sketches; the rows themselves are not read again."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(alias))


def error_bound(deviations: float = 5, lg_k: int = LG_K) -> float:
    """The relative error that so many standard deviations are."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)
