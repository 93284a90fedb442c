"""Flattening raw feed records into raw-layer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .moments import parse_iso
from .tags import TagVocabulary, extract_owner, tag_columns, tag_groups


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def or_empty(items: Column) -> Column:
    return F.coalesce(items, _no_strings())


def _names(items: Column, field: str) -> Column:
    """One field of each element, without the absent ones."""
    found = F.filter(F.transform(items, lambda i: i[field]), lambda v: v.isNotNull())
    return or_empty(found)


def with_tag_columns(df: DataFrame, vocabulary: TagVocabulary, tags: str = "tags") -> DataFrame:
    """Tags as columns of their own, so that those nobody reads are not derived."""
    groups = tag_groups(F.col(tags), vocabulary)
    found = tag_columns(**{name: F.col(f"_{name}") for name in groups}, vocabulary=vocabulary)
    return df.withColumns({f"_{name}": group for name, group in groups.items()}).select(
        *[c for c in df.columns if c != tags], *[c.alias(n) for n, c in found.items()]
    )


def flat_models(raw: DataFrame, *kept: str) -> DataFrame:
    """Model records without tag columns: owner, defaults of 0 for metrics, and ``kept``.

    JSON read with a schema cannot tell a missing metric from an explicit null;
    both become 0.
    """
    return raw.select(
        "id",
        extract_owner(F.col("id")).alias("owner"),
        parse_iso(F.col("created_at")).alias("created_at"),
        F.coalesce("downloads", F.lit(0)).cast("long").alias("downloads"),
        F.coalesce("likes", F.lit(0)).cast("int").alias("likes"),
        "library_name",
        "pipeline_tag",
        F.coalesce("trending_score", F.lit(0.0)).alias("trending_score"),
        *_carried(raw),
        *kept,
    )


def project_models(raw: DataFrame, vocabulary: TagVocabulary) -> DataFrame:
    """Model records: owner, defaults of 0 for metrics, tags as columns."""
    return with_tag_columns(flat_models(raw, "tags"), vocabulary)


def project_papers(raw: DataFrame) -> DataFrame:
    """Paper records: submitter and organisation reduced to their names."""
    return raw.select(
        "id",
        or_empty(F.col("authors")).alias("authors"),
        parse_iso(F.col("published_at")).alias("published_at"),
        "title",
        "summary",
        F.coalesce("upvotes", F.lit(0)).cast("int").alias("upvotes"),
        "discussion_id",
        "source",
        F.coalesce("comments", F.lit(0)).cast("int").alias("comments"),
        parse_iso(F.col("submitted_at")).alias("submitted_at"),
        submitter_name(raw).alias("submitted_by"),
        "ai_summary",
        "ai_keywords",
        F.col("organization.name").alias("organization"),
        *_carried(raw),
    )


def submitter_name(raw: DataFrame) -> Column:
    """The submitter's user name, whether nested or already flat."""
    nested = raw.schema["submitted_by"].dataType.typeName() == "struct"
    return F.col("submitted_by.username" if nested else "submitted_by")


def project_posts(raw: DataFrame) -> DataFrame:
    """Post records: author, mention and attachment objects reduced to text."""
    return raw.select(
        "slug",
        F.col("author.name").alias("author"),
        F.col("rawContent").alias("content_raw"),
        parse_iso(F.col("publishedAt")).alias("published_at"),
        parse_iso(F.col("updatedAt")).alias("updated_at"),
        F.col("totalUniqueImpressions").cast("int").alias("total_unique_impressions"),
        F.col("numComments").cast("int").alias("num_comments"),
        "reactions",
        _names(F.col("mentions"), "name").alias("mentions"),
        _names(F.col("attachments"), "type").alias("attachments"),
        *_carried(raw),
    )


def _carried(raw: DataFrame) -> list[str]:
    """Bookkeeping columns a landed batch may already have."""
    return [c for c in ("loaded_at", "position") if c in raw.columns]
