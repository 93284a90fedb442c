"""Nested records to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.moments import date_text, hour_text
from ...functions.records import or_empty
from ...operators import flatten
from ..given import Given
from ..registry import listed, query


@query("""
    SELECT slug, position, reaction, trim(u) AS user_name, strftime(loaded_at, '%Y-%m-%d') AS date,
      strftime(loaded_at, '%H') || ':00:00' AS time
    FROM (SELECT slug, position, loaded_at, r.reaction AS reaction, unnest(r.users) AS u
          FROM (SELECT *, unnest(reactions) AS r FROM ods_posts))
    WHERE trim(u) <> ''""")
def explode_reactions(g: Given) -> DataFrame:
    rows = flatten.explode_reactions(g.posts, ["slug", "position", "loaded_at"])
    return rows.select(
        "slug", "position", "reaction", "user_name",
        date_text(F.col("loaded_at")).alias("date"), hour_text(F.col("loaded_at")).alias("time"),
    )


@query("""
    SELECT element, count(*) AS n FROM (
      SELECT unnest(dataset) AS element FROM ods_models
      UNION ALL SELECT unnest(authors) FROM ods_papers
      UNION ALL SELECT unnest(ai_keywords) FROM ods_papers) GROUP BY 1""")
def unnest_array(g: Given) -> DataFrame:
    elements = (
        flatten.unnest(g.models, "dataset", "element")
        .unionByName(flatten.unnest(g.papers, "authors", "element"))
        .unionByName(flatten.unnest(g.papers, "ai_keywords", "element"))
    )
    return elements.groupBy("element").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT u AS user_name, count(*) AS n FROM (
      SELECT unnest(r.users) AS u FROM (SELECT unnest(reactions) AS r FROM ods_posts)) GROUP BY 1""")
def json_text_elements(g: Given) -> DataFrame:
    """User texts out of reactions stored as JSON text."""
    stored = g.posts.select(F.to_json("reactions").alias("text"))
    parsed = stored.select(flatten.parse_reactions(F.col("text")).alias("reactions"))
    return flatten.reaction_users(parsed).groupBy("user_name").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT id, position, array_to_string(authors, ',') AS authors,
      coalesce(len(ai_keywords), 0) AS keywords FROM ods_papers""")
def pair_map(g: Given) -> DataFrame:
    """Each paper with its lists; a missing list is an empty one."""
    return g.papers.select(
        "id", "position", listed("authors").alias("authors"),
        F.size(or_empty(F.col("ai_keywords"))).cast("long").alias("keywords"),
    )
