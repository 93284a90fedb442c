"""Many-to-many tables.

Entities come one row per id, as a load has them after deduplication.  A list is
reduced to its distinct elements in place, so the pairs are distinct without a
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import md5_key
from .flatten import unnest
from .lookups import with_code_id


def pairs(entities: DataFrame, entity_id: str, array: str) -> DataFrame:
    """Distinct (entity, element) pairs."""
    once = entities.select(entity_id, F.array_distinct(array).alias(array))
    return unnest(once, array, "element", [entity_id]).where("element IS NOT NULL")


def code_bridge(
    entities: DataFrame,
    entity_id: str,
    array: str,
    dimension: DataFrame,
    code: str,
    out: str,
    by_slug: bool = False,
) -> DataFrame:
    """Pairs with a small fixed dictionary; elements it lacks are dropped."""
    found = with_code_id(
        pairs(entities, entity_id, array), dimension, code, "element", out, by_slug
    )
    return found.select(entity_id, out)


def name_bridge(entities: DataFrame, entity_id: str, array: str, out: str) -> DataFrame:
    """Pairs with a growing dictionary that the same batch has been added to.

    Every element is in the dictionary by then and its id is a digest of the name,
    so there is no join and no name, however common, gathers rows in one place.
    """
    return pairs(entities, entity_id, array).select(
        entity_id, md5_key(F.col("element")).alias(out)
    )
