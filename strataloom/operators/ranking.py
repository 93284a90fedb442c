"""Top-k, ranks and exact percentiles without a single-task sort of everything."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

# A percentile sketch of this accuracy errs by at most one rank in 10,000.
_SKETCH_ACCURACY = 10000
# A bracket reaches this many sketch errors to both sides; groups it misses try again with
# one that is wider by the other factor.
_SLACK, _WIDER = 4, 8


def top_k(df: DataFrame, k: int, value: str, tie_break: Sequence[str]) -> DataFrame:
    return df.orderBy(F.col(value).desc_nulls_last(), *tie_break).limit(k)


def ranked_top_k(
    df: DataFrame, k: int, value: str, tie_break: Sequence[str], rank_name: str = "rank"
) -> DataFrame:
    """The k best rows with their competition rank.

    A rank depends only on rows with greater values, and all of those are among
    the k best, so the rows are cut before they are ranked: the window sees k rows.
    """
    rank = F.rank().over(Window.orderBy(F.col(value).desc_nulls_last()))
    return top_k(df, k, value, tie_break).withColumn(rank_name, rank)


def counts_by(df: DataFrame, label: Column | str, name: str = "cnt") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias(name))


def top_groups(
    df: DataFrame, label: str, limit: int | None = None, name: str = "cnt"
) -> DataFrame:
    """Row counts per label, greatest first, equal counts by label."""
    ordered = counts_by(df, label, name).orderBy(F.col(name).desc(), F.col(label))
    return ordered if limit is None else ordered.limit(limit)


def percentile_by(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    share: float = 0.5,
    name: str = "percentile",
    few_groups: bool = False,
    accuracy: int = _SKETCH_ACCURACY,
) -> DataFrame:
    """Exact continuous percentile per group, for groups of any size.

    The built-in aggregate keeps all distinct values of a group in one task.
    Here a bounded sketch first brackets the wanted rank; then one aggregation
    counts what lies below the bracket and counts each value inside it.  Only the
    bracket, a thousandth of the group, is ordered.  Groups whose rank lies outside
    their bracket are counted again with wider ones, which in the end hold all values.
    ``few_groups`` states that their number is bounded, as days of a month are, so that
    the brackets may be broadcast and the rows need no shuffle for them.
    """
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"))
    slack, parts = _SLACK / accuracy, []
    while True:
        picked = stored(_picked(rows, group, share, slack, accuracy, few_groups), "percentile")
        inside = F.col("_lo").isNotNull() & F.col("_hi").isNotNull()
        exact = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")
        parts.append(picked.where(inside).select(*group, exact.alias(name)))
        missed = picked.where(~inside).select(*[F.col(g).alias(f"_of_{g}") for g in group])
        if slack >= 1 or not missed.take(1):
            return reduce(DataFrame.unionByName, parts)
        rows = rows.join(missed, _same_group(group), "left_semi")
        slack *= _WIDER


def _same_group(group: Sequence[str]) -> Column:
    """A group and the group named ``_of_``; NULL is a group."""
    return reduce(
        lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group], F.lit(True)
    )


def _picked(
    rows: DataFrame, group: Sequence[str], share: float, slack: float, accuracy: int, few_groups: bool
) -> DataFrame:
    """Per group the values on both sides of the rank; NULL where the bracket misses one."""
    shares = [max(0.0, share - slack), min(1.0, share + slack)]
    sketch = rows.groupBy(*group).agg(
        F.percentile_approx("_v", shares, accuracy).alias("_b"),
        F.min("_v").alias("_least"), F.max("_v").alias("_most"),
        F.count(F.lit(1)).alias("_n"),
    )
    # A bracket that reaches an end of the shares holds the values up to that end.
    low = F.col("_least") if shares[0] == 0 else F.col("_b")[0]
    high = F.col("_most") if shares[1] == 1 else F.col("_b")[1]
    bracket = sketch.select(
        *[F.col(g).alias(f"_of_{g}") for g in group], low.alias("_low"), high.alias("_high"), "_n"
    )
    if few_groups:
        bracket = F.broadcast(bracket)
    # The label of a row: NULL below the bracket, its value inside it.
    label = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))
    counted = (
        rows.join(bracket, _same_group(group))
        .where(F.col("_v") <= F.col("_high"))
        .groupBy(*group, label.alias("_x"))
        .agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    )
    ordered = Window.partitionBy(*group).orderBy(F.col("_x").asc_nulls_first())
    upto = F.sum("_c").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    position = (F.col("_n") - 1) * F.lit(share)

    def holds(rank: Column) -> Column:
        return (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))

    return (
        counted.withColumn("_upto", upto)
        .groupBy(*group)
        .agg(
            F.max(F.when(holds(F.floor(position)), F.col("_x"))).alias("_lo"),
            F.max(F.when(holds(F.ceil(position)), F.col("_x"))).alias("_hi"),
            F.first(position - F.floor(position)).alias("_part"),
        )
    )
