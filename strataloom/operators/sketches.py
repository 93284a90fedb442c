"""Distinct counts that merge: one HyperLogLog sketch per day and label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A sketch has two to this power registers, 12 kB; its relative standard error follows.
REGISTERS_LOG = 14
STANDARD_ERROR = 1.04 / 2 ** (REGISTERS_LOG / 2)
# Estimates are held to four standard errors and half a row.
ERRORS = 4


def daily_sketches(rows: DataFrame, day: str, labels: Sequence[str], value: str) -> DataFrame:
    """``day, labels, sketch``: the different ``value`` of each day and label.

    Partial sketches are merged before the shuffle, so it carries one sketch per label,
    day and input partition however many rows there are.  NULL values do not count.
    """
    return rows.groupBy(day, *labels).agg(F.hll_sketch_agg(value, REGISTERS_LOG).alias("sketch"))


def merged_distinct(sketches: DataFrame, labels: Sequence[str], name: str = "estimate") -> DataFrame:
    """Different values per label over all days of ``sketches``; no row is read again."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*labels).agg(union.alias(name))


def within_bound(estimate: Column, exact: Column) -> Column:
    """Whether an estimate keeps the stated error."""
    return F.abs(estimate - exact) <= F.lit(ERRORS * STANDARD_ERROR) * exact + 0.5
