"""Selecting from a landed feed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import top_k

# Page length of the post feed, its look-back and the model feed's size.
PAGE_ITEMS = 10
LOOK_BACK_HOURS = 24
TOP_MODELS = 50


def top_by_score(
    df: DataFrame,
    n: int = TOP_MODELS,
    score: str = "trending_score",
    tie_break: Sequence[str] = ("id",),
) -> DataFrame:
    """The n records with the highest score."""
    return top_k(df, n, score, tie_break)


def recent_feed(
    df: DataFrame,
    as_of: dt.datetime,
    published: Column,
    key: str,
    exact: bool = True,
    hours: int = LOOK_BACK_HOURS,
) -> DataFrame:
    """Feed items of the last hours.

    ``exact`` keeps just those.  Otherwise whole pages are kept, newest first, up
    to and including the first page whose last item is older.  Since the feed is
    sorted, that page is completed by the few newest old items, so neither form
    numbers the feed.
    """
    cutoff = F.lit(as_of - dt.timedelta(hours=hours))
    is_recent = F.coalesce(published >= cutoff, F.lit(False))
    recent = df.where(is_recent)
    if exact:
        return recent
    # The old items that share a page with the last recent one: at least one, at
    # most a page, so the window below sees ten rows.
    place = F.row_number().over(Window.orderBy(published.desc_nulls_last(), key))
    missing = F.lit(PAGE_ITEMS) - recent.agg(F.count(F.lit(1))).scalar() % PAGE_ITEMS
    newest_old = (
        df.where(~is_recent)
        .orderBy(published.desc_nulls_last(), key)
        .limit(PAGE_ITEMS)
        .withColumn("_place", place)
        .where(F.col("_place") <= missing)
        .drop("_place")
    )
    return recent.unionByName(newest_old)
