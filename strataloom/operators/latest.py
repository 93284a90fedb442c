"""One row per key, last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest by ``order``.

    A limit on a row number is applied before the shuffle too, so a key with very
    many rows sends one row per input partition; and unlike an aggregate over
    whole rows it lets Spark drop columns nobody reads.  NULLs count as smallest.
    ``order`` should be total within a key.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in order]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*newest_first))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def upsert_latest(
    base: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The table after an upsert: incoming rows replace rows of the same key.

    ``order`` picks among incoming rows with one key.
    """
    fresh = latest_by_key(incoming, key, order).select(*base.columns)
    kept = base.join(fresh.select(*key), list(key), "left_anti").select(*base.columns)
    return kept.unionByName(fresh)


def partition_values(incoming: DataFrame, partition: str) -> list:
    """The partitions a batch writes to, one value each."""
    return [r[0] for r in incoming.select(partition).distinct().collect()]


def touched_partitions(
    base: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    partition: str,
    values: Sequence | None = None,
) -> DataFrame:
    """New content of just those partitions that the batch writes to.

    Written with dynamic partition overwrite, so the cost follows the batch.  The
    values the batch touches are read first, one per partition, and passed to the
    scan as constants: partitions without news are not read.  A caller that has read them
    passes them as ``values``.
    """
    if values is None:
        values = partition_values(incoming, partition)
    return upsert_latest(base.where(F.col(partition).isin(values)), incoming, key, order)


def hourly_latest(
    df: DataFrame, key: Sequence[str], moment: str, order: Sequence[str]
) -> DataFrame:
    """One metric row per key and hour, the last one of the hour."""
    hourly = df.withColumn("hour", F.date_trunc("HOUR", F.col(moment)))
    return latest_by_key(hourly, [*key, "hour"], [moment, *order])
