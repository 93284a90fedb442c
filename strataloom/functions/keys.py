"""Hash keys and change hashes.

Keys are digests of business keys: they need no counter, are the same on every
replay, and can be computed on the fact side without a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .moments import date_text, hour_text
from .text import sorted_join

# Fixed value: how an absent attribute is spelled inside a change hash.
NULL_TOKEN = "None"

# Attributes of a model that make a new version, in hash order.
MODEL_HASH_SCALARS = (
    "name", "owner", "library_name", "pipeline_tag", "license",
    "modification", "region", "diffusers_pipeline", "deploy",
)
MODEL_HASH_LISTS = ("language", "library", "task", "dataset")


def md5_key(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def md5_upper(text: Column) -> Column:
    return F.upper(F.md5(text))


def md5_uuid(text: Column) -> Column:
    """The digest in 8-4-4-4-12 form."""
    return F.regexp_replace(
        F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )


def version_key(business_key: Column, valid_from: Column) -> Column:
    return md5_key(business_key, F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def hashdiff(scalars: Sequence[Column], lists: Sequence[Column] = ()) -> Column:
    parts = [c.cast("string") for c in scalars] + [sorted_join(c) for c in lists]
    return F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit(NULL_TOKEN)) for p in parts]))


def model_hash() -> Column:
    return hashdiff(
        [F.col(c) for c in MODEL_HASH_SCALARS], [F.col(c) for c in MODEL_HASH_LISTS]
    )


def post_hash() -> Column:
    """Content and the publish and update hours; metrics are left out."""
    published, updated = F.col("published_at"), F.col("updated_at")
    return hashdiff(
        [
            F.col("slug"), F.col("author"), F.col("content_raw"),
            date_text(published), hour_text(published),
            date_text(updated), hour_text(updated),
        ]
    )


def party_hash(name: Column, kind: Column) -> Column:
    """Name and type with a separator, so that ``ab|c`` and ``a|bc`` differ."""
    return hashdiff([name, kind])
