"""Versioned dimensions (SCD type 2): rebuild, apply a batch, read as of a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import version_key
from ..session import stored
from .latest import latest_by_key

# Fixed value: an open version ends this many days after it starts.
OPEN_DAYS = 36500

VERSION_COLUMNS = ("id", "valid_from", "valid_to", "is_current")

# A live part stored by key carries this column; a load reads only the buckets of its keys.
BUCKET = "bucket"
BUCKETS = 256

# What a load does to a version.
KEPT, SAME, CLOSED, BEGUN = "kept", "same", "closed", "begun"


@dataclass(frozen=True)
class VersionChange:
    """What one batch does to a dimension.

    ``current`` is the new live part, of a dimension stored by key the part in the
    buckets the batch touches; ``closed`` are the versions it ended; the history before
    the batch is not read.  ``spoken`` is the part of ``current`` the batch spoke about,
    ``inserted`` and ``unchanged`` together.  All are filters on one stored table.
    """

    current: DataFrame
    closed: DataFrame
    inserted: DataFrame
    unchanged: DataFrame
    spoken: DataFrame


def open_end(start: Column, days: int = OPEN_DAYS) -> Column:
    return start + F.make_dt_interval(F.lit(days))


def rebuild_versions(
    rows: DataFrame,
    key: str,
    moment: str = "loaded_at",
    change: str = "hashdiff",
    order: Sequence[str] = (),
    open_days: int = OPEN_DAYS,
) -> DataFrame:
    """All versions from the whole history of loads.

    First one row per key and load is kept, with partial aggregation, so a window
    group holds at most one row per load however many rows a key has.  Rows that
    repeat the load before are then dropped and each version ends where the next
    one starts.
    """
    per_load = latest_by_key(rows, [key, moment], [*order, change])
    timeline = Window.partitionBy(key).orderBy(moment)
    starts = per_load.withColumn("_before", F.lag(change).over(timeline)).where(
        ~F.col("_before").eqNullSafe(F.col(change))
    )
    next_start = F.lead(moment).over(timeline)
    keep = [c for c in rows.columns if c not in (moment, *order)]
    return (
        starts.withColumn("_next", next_start)
        .withColumn("valid_from", F.col(moment))
        .withColumn("valid_to", F.coalesce("_next", open_end(F.col(moment), open_days)))
        .withColumn("is_current", F.col("_next").isNull())
        .withColumn("id", version_key(F.col(key), F.col(moment)))
        .select("id", *keep, "valid_from", "valid_to", "is_current")
    )


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def joined_change(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    loaded_at: dt.datetime,
    change: str = "hashdiff",
    open_days: int = OPEN_DAYS,
) -> DataFrame:
    """What a batch does, version by version: the columns of ``current`` and an ``action``.

    One full outer join on the key, unique on either side; a changed key gives two rows.
    """
    start = F.lit(loaded_at)
    begun = {
        "id": version_key(F.col(key), start),
        "valid_from": start,
        "valid_to": open_end(start, open_days),
        "is_current": F.lit(True),
    }
    old = current.select(*[F.col(c).alias(f"_old_{c}") for c in current.columns], F.lit(True).alias("_had"))
    new = incoming.select(
        *[
            begun.get(f.name, F.col(f.name)).cast(f.dataType).alias(f"_new_{f.name}")
            for f in current.schema
        ],
        F.lit(True).alias("_sent"),
    )
    both = old.join(new, F.col(f"_old_{key}") == F.col(f"_new_{key}"), "full_outer")
    had, sent = F.col("_had").isNotNull(), F.col("_sent").isNotNull()
    same = had & sent & F.col(f"_old_{change}").eqNullSafe(F.col(f"_new_{change}"))
    ended = {"valid_to": start, "is_current": F.lit(False)}

    def version(action: str, side: str, other: dict[str, Column] | None = None) -> Column:
        fields = [
            (other or {}).get(f.name, F.col(f"_{side}_{f.name}")).cast(f.dataType).alias(f.name)
            for f in current.schema
        ]
        return F.struct(F.lit(action).alias("action"), *fields)

    rows = (
        F.when(~sent, F.array(version(KEPT, "old")))
        .when(same, F.array(version(SAME, "old")))
        .when(had, F.array(version(CLOSED, "old", ended), version(BEGUN, "new")))
        .otherwise(F.array(version(BEGUN, "new")))
    )
    return both.select(F.explode(rows).alias("version")).select("version.*")


def apply_versions(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    loaded_at: dt.datetime,
    change: str = "hashdiff",
    open_days: int = OPEN_DAYS,
) -> VersionChange:
    """One batch against the live versions; both sides have one row per key.

    Same hash: the version stays, with its id and owner.  Other hash: it ends at
    ``loaded_at`` and a new one starts.  New key: inserted.  Absent key: stays.
    The joined change is written once to the shared scratch folder, and every part of
    it is a filter on that table.  If ``current`` is stored by key (it has a column
    ``bucket``), only the buckets of the batch's keys are read.
    """
    if BUCKET in current.columns:
        incoming = stored(incoming.withColumn(BUCKET, bucket_of(F.col(key))), "incoming")
        touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]
        current = current.where(F.col(BUCKET).isin(touched))
    attributes = {c for c in current.columns if c not in VERSION_COLUMNS}
    if not attributes <= set(incoming.columns):
        raise ValueError(f"the batch lacks {sorted(attributes - set(incoming.columns))}")
    done = stored(joined_change(current, incoming, key, loaded_at, change, open_days), "versions")

    def part(*actions: str) -> DataFrame:
        return done.where(F.col("action").isin(*actions)).drop("action")

    return VersionChange(
        current=part(KEPT, SAME, BEGUN),
        closed=part(CLOSED),
        inserted=part(BEGUN),
        unchanged=part(SAME),
        spoken=part(SAME, BEGUN),
    )


def as_of(dimension: DataFrame, moment: dt.datetime) -> DataFrame:
    """The versions valid at one moment."""
    at = F.lit(moment)
    return dimension.where((F.col("valid_from") <= at) & (at < F.col("valid_to")))


def as_of_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    moment: str,
    unit: str = "month",
) -> DataFrame:
    """Each fact with the version of its key valid at its time.

    Versions are laid out over the calendar units they span, so the join is an
    equality on key and unit: a hot key is spread over its units and a fact meets
    only the versions of its own unit.  The first and the last time of the facts,
    one aggregate, bound the layout; a fact without time has no version.
    """
    ends = facts.agg(F.min(moment).alias("first"), F.max(moment).alias("last"))

    def unit_of(column: Column) -> Column:
        return F.date_trunc(unit, column)

    first = ends.select("first").scalar()
    last = ends.select("last").scalar()
    low = unit_of(F.greatest(F.col("valid_from"), first))
    high = unit_of(F.least(F.col("valid_to"), last))
    laid_out = (
        dimension.where((F.col("valid_from") <= last) & (F.col("valid_to") > first))
        .withColumn("_unit", F.explode(F.sequence(low, high, F.expr(f"interval 1 {unit}"))))
    )
    timed = facts.withColumn("_unit", unit_of(F.col(moment)))
    inside = (F.col(moment) >= F.col("valid_from")) & (F.col(moment) < F.col("valid_to"))
    return timed.join(laid_out, [key, "_unit"]).where(inside).drop("_unit")
