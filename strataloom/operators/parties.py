"""People and organisations from all feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import party_hash
from ..functions.text import strip_to_null
from .flatten import explode_reactions, reaction_users


def owner_types(owners: DataFrame, known_users: DataFrame, name: str = "name") -> DataFrame:
    """Distinct owners, ``user`` when the name is a known user, else ``org``."""
    once = owners.select(strip_to_null(F.col(name)).alias("name")).where("name IS NOT NULL")
    users = known_users.select("name").distinct().withColumn("_known", F.lit(True))
    return once.distinct().join(users, "name", "left").select(
        "name", F.when(F.col("_known"), "user").otherwise("org").alias("type")
    )


def _named(df: DataFrame, column: str, kind: str) -> DataFrame:
    return (
        df.select(strip_to_null(F.col(column)).alias("name"))
        .where("name IS NOT NULL")
        .withColumn("type", F.lit(kind))
    )


def paper_parties(papers: DataFrame) -> DataFrame:
    return _named(papers, "submitted_by", "user").unionByName(_named(papers, "organization", "org"))


def post_parties(posts: DataFrame) -> DataFrame:
    reacting = explode_reactions(posts)
    return _named(posts, "author", "user").unionByName(_named(reacting, "user_name", "user"))


def one_per_name(*candidates: DataFrame) -> DataFrame:
    """One row per name; a name seen as both is an ``org``."""
    everyone = reduce(DataFrame.unionByName, candidates)
    kind = F.when(F.max(F.col("type") == "org"), "org").otherwise("user")
    return everyone.groupBy("name").agg(kind.alias("type")).withColumn(
        "hashdiff", party_hash(F.col("name"), F.col("type"))
    )


def all_party_names(models: DataFrame, papers: DataFrame, posts: DataFrame) -> DataFrame:
    """Every mention of a party in the raw layer, one row each, trimmed."""
    mentions = [
        models.select(F.col("owner").alias("name")),
        papers.select(F.col("submitted_by").alias("name")),
        papers.select(F.col("organization").alias("name")),
        posts.select(F.col("author").alias("name")),
        reaction_users(posts).select(F.col("user_name").alias("name")),
    ]
    everyone = reduce(DataFrame.unionByName, mentions)
    return everyone.select(strip_to_null(F.col("name")).alias("name")).where("name IS NOT NULL")
