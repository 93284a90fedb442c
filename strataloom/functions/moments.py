"""Timestamps, calendar keys and time windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(text: Column) -> Column:
    """ISO text (``Z`` or an offset allowed) to a timestamp; bad text is NULL.

    Text without a full date is bad: a clock time alone would mean the day of the run.
    """
    dated = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ]|$)")
    return F.when(dated, text.try_cast("timestamp"))


def iso_text(moment: Column) -> Column:
    """UTC ISO text with microseconds, the staging form of a timestamp."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def date_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def hour_text(moment: Column) -> Column:
    """Clock time cut to the hour, as ``HH:00:00``."""
    return F.concat(F.date_format(moment, "HH"), F.lit(":00:00"))


def date_id(moment: Column) -> Column:
    """Calendar key ``yyyymmdd`` as an integer, ordered like the dates."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")


def time_id(moment: Column) -> Column:
    return F.hour(moment)


def recent_days(day: Column, as_of: dt.date, days: int) -> Column:
    """Days from ``as_of - days`` up to and including ``as_of``."""
    return day.between(F.lit(as_of - dt.timedelta(days=days)), F.lit(as_of))


def date_id_of(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def recent_date_ids(key: Column, as_of: dt.date, days: int) -> Column:
    """The same window on integer keys, so that it prunes fact partitions."""
    first = date_id_of(as_of - dt.timedelta(days=days))
    return key.between(F.lit(first), F.lit(date_id_of(as_of)))
