"""Nested reactions and lists to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import safe_int
from ..functions.text import strip_to_null
from ..schemas import REACTION_DDL


def parse_reactions(text: Column) -> Column:
    """JSON text to typed reactions; anything that is not such a list is NULL."""
    return F.from_json(text, REACTION_DDL)


def _counts(reaction: Column) -> Column:
    """A reaction with a code and at least one listed user."""
    return (
        (F.coalesce(reaction["reaction"], F.lit("")) != "")
        & (F.coalesce(F.size(reaction["users"]), F.lit(0)) > 0)
    )


def reaction_total(reactions: Column) -> Column:
    """Sum of the stated counts of a post's reactions."""
    return F.aggregate(
        F.filter(F.coalesce(reactions, F.array().cast(REACTION_DDL)), _counts),
        F.lit(0).cast("long"),
        lambda total, r: total + safe_int(r["count"]),
    )


def explode_reactions(posts: DataFrame, keep: Sequence[str] = ("slug",)) -> DataFrame:
    """One row per post, reaction and user; blank users are dropped."""
    return (
        posts.select(*keep, F.explode("reactions").alias("_r"))
        .where(_counts(F.col("_r")))
        .select(*keep, F.col("_r.reaction").alias("reaction"), F.explode("_r.users").alias("_u"))
        .withColumn("user_name", strip_to_null(F.col("_u")))
        .where("user_name IS NOT NULL")
        .drop("_u")
    )


def reaction_users(posts: DataFrame) -> DataFrame:
    """Every user text listed under any reaction, as stored."""
    return (
        posts.select(F.explode("reactions").alias("r"))
        .select(F.explode("r.users").alias("user_name"))
    )


def unnest(df: DataFrame, array: str, out: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per list element; absent and empty lists give none."""
    return df.select(*keep, F.explode(array).alias(out))


def distinct_elements(df: DataFrame, array: str, out: str = "name") -> DataFrame:
    """Distinct present elements of a list column over all rows."""
    return unnest(df, array, out).where(F.col(out).isNotNull()).distinct()
