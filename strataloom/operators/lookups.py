"""Attaching dimension keys to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.moments import date_id, time_id
from ..functions.text import slug


def with_calendar(df: DataFrame, dates: DataFrame, moment: str, prefix: str = "") -> DataFrame:
    """Add ``<prefix>date_id`` and ``<prefix>time_id`` of one timestamp column.

    Both are NULL when the calendar does not have the day.  The calendar has a
    fixed number of days, so it is broadcast.
    """
    day, hour = f"{prefix}date_id", f"{prefix}time_id"
    known = F.broadcast(dates.select(F.col("id").alias(day)))
    return (
        df.withColumn(day, date_id(F.col(moment)))
        .join(known.withColumn("_known", F.lit(True)), day, "left")
        .withColumn(hour, F.when(F.col("_known"), time_id(F.col(moment))))
        .withColumn(day, F.when(F.col("_known"), F.col(day)))
        .drop("_known")
    )


def with_code_id(
    df: DataFrame, dimension: DataFrame, code: str, column: str, out: str, by_slug: bool = False
) -> DataFrame:
    """Rows whose code is in a small fixed dictionary, with its id.

    Languages, libraries, tasks and reactions have at most a few hundred fixed
    entries and are broadcast.  ``by_slug`` compares in tag form.
    """
    entry = slug(F.col(code)) if by_slug else F.col(code)
    found = F.broadcast(dimension.select(entry.alias(column), F.col("id").alias(out)))
    return df.join(found, column)


def with_name_id(df: DataFrame, dictionary: DataFrame, column: str, out: str) -> DataFrame:
    """Rows whose name is in a growing dictionary, with its id; a shuffle join."""
    found = dictionary.select(F.col("name").alias(column), F.col("id").alias(out))
    return df.join(found, column)


def with_party_id(
    df: DataFrame, parties: DataFrame, name: str, out: str, how: str = "left"
) -> DataFrame:
    """Add the id of the party version that is current.

    A left join keeps rows without name; they get keys of their own that no party has,
    so they are dealt over all partitions.
    """
    live = parties.where("is_current").select(F.col("name").alias("_party"), F.col("id").alias(out))
    at = F.col(name)
    if how == "left":
        nobody = F.concat(F.lit("\0"), F.xxhash64(*df.columns).cast("string"))
        at = F.coalesce(at, nobody)
    return df.withColumn("_at", at).join(live, F.col("_at") == F.col("_party"), how).drop("_at", "_party")


def keep_known(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Rows whose value occurs in another table's column of the same name."""
    return df.join(known.select(column).distinct(), column, "left_semi")


def any_match(df: DataFrame, other: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Inner join with at most one match per row: the other side's first row of a key."""
    rest = [c for c in other.columns if c != key]
    first = other.groupBy(key).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    )
    return df.join(first.select(key, "_first.*"), key)


def reasons(**checks: Column) -> Column:
    """The first failed check of a row, or NULL; each check is true when it holds."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return F.coalesce(*failed)


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejects with their reason); together they are the input."""
    marked = df.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")
