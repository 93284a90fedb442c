"""From a load of the raw layer to changes of the detail layer.

Each flow returns what a load does to every table; ``commit`` stores it.  Loads are
reduced to one row per entity first, so every join below has unique keys on at least
one side.  These rows and the ids a load speaks about are written to the shared scratch
folder, as large as the load, and everything else is derived from them: no feed is
read twice, and a lost executor repeats a task and not the load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import md5_key, model_hash, post_hash
from ..functions.moments import date_id, time_id
from ..functions.numbers import nan_to_null, safe_int
from ..functions.records import or_empty
from ..functions.text import strip_to_null
from ..operators import bridges, dimensions
from ..operators.dimensions import insert_ignore, new_rows
from ..operators.flatten import distinct_elements, explode_reactions, reaction_total
from ..operators.latest import latest_by_key, partition_values, touched_partitions
from ..operators.lookups import reasons, split_rejects, with_calendar, with_code_id, with_party_id
from ..operators.parties import one_per_name, owner_types, paper_parties, post_parties
from ..operators.versions import VersionChange, apply_versions
from ..schemas import table
from ..session import stored
from ..sources.ledger import BEGUN, ENDED, Ledger
from ..sources.tables import Warehouse

MODEL_ATTRIBUTES = (
    "library_name", "pipeline_tag", "license", "modification", "region",
    "diffusers_pipeline", "deploy",
)


@dataclass(frozen=True)
class StaticDimensions:
    date: DataFrame
    time: DataFrame
    languages: DataFrame
    libraries: DataFrame
    tasks: DataFrame
    reactions: DataFrame

    @classmethod
    def generate(cls, spark: SparkSession) -> StaticDimensions:
        return cls(
            date=dimensions.dim_date(spark),
            time=dimensions.dim_time(spark),
            languages=dimensions.dim_languages(spark),
            libraries=dimensions.dim_libraries(spark),
            tasks=dimensions.dim_tasks(spark),
            reactions=dimensions.dim_reactions(spark),
        )

    def by_table(self) -> dict[str, DataFrame]:
        return {f"dds.dim_{name}": rows for name, rows in vars(self).items()}


@dataclass(frozen=True)
class Load:
    """What one load changes.

    ``versions`` are versioned dimensions, ``rows`` candidates for insert-only
    tables and bridges, one per key, ``facts`` rows of fact tables, ``rejects`` what
    was left out and why.
    """

    loaded_at: dt.datetime
    versions: dict[str, VersionChange]
    rows: dict[str, DataFrame]
    facts: dict[str, DataFrame]
    rejects: DataFrame


def entity_ids(change: VersionChange, key: str, out: str) -> DataFrame:
    """Version ids and starts of the entities a load spoke about."""
    return change.spoken.select(
        key, F.col("id").alias(out), F.col("valid_from").alias("version_from")
    )


def named_models(batch: DataFrame) -> DataFrame:
    """Raw model rows with their name and the owner's name without white space."""
    return batch.withColumn("name", F.col("id")).withColumn("owner", strip_to_null(F.col("owner")))


def prepared_models(batch: DataFrame) -> DataFrame:
    """Detail attributes and the change hash of raw model rows."""
    return named_models(batch).withColumn("hashdiff", model_hash())


def models_load(
    batch: DataFrame,
    parties: DataFrame,
    models: DataFrame,
    known_users: DataFrame,
    static: StaticDimensions,
    loaded_at: dt.datetime,
    order: Sequence[str],
    strict: bool = False,
    whole: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Load:
    """``parties`` and ``models`` are the live versions before the load.

    ``whole`` adds the columns that ``batch`` lacks; they are derived, row by row, after the
    load is reduced, so that wide columns of older rows are not sorted or shuffled.
    """
    newest = latest_by_key(batch, ["id"], order)
    rows = stored(prepared_models(whole(newest)), "load-rows")
    owners = one_per_name(owner_types(rows.select(F.col("owner").alias("name")), known_users))
    party_change = apply_versions(parties, owners, "name", loaded_at)
    live = party_change.spoken

    # Every owner is a party by now, so a row's own columns decide on its fate.
    accepted, rejects = split_rejects(
        with_calendar(rows, static.date, "created_at"),
        reasons(no_owner=F.col("owner").isNotNull(), no_created_date=F.col("date_id").isNotNull()),
    )
    incoming = with_party_id(
        accepted.select("name", "owner", *MODEL_ATTRIBUTES, "date_id", "time_id", "hashdiff"),
        live, "owner", "owner_id", how="inner",
    ).drop("owner")
    change = apply_versions(models, incoming, "name", loaded_at)
    known = stored(rows.join(entity_ids(change, "name", "model_id"), "name"), "load-models")
    # The change hash covers all lists, so only versions of this load have new pairs.
    fresh = known.where(F.col("version_from") == F.lit(loaded_at))

    metrics = with_calendar(
        known.select("model_id", "loaded_at", "downloads", "likes", "trending_score"),
        static.date, "loaded_at",
    ).where("date_id IS NOT NULL").select(
        "model_id",
        safe_int(F.col("downloads")).alias("downloads"),
        safe_int(F.col("likes")).alias("likes"),
        F.coalesce(nan_to_null(F.col("trending_score")), F.lit(0.0)).alias("trending_score"),
        "date_id", "time_id",
    )
    by_slug = not strict
    pairs = {
        "dds.bridge_models_languages": bridges.code_bridge(
            fresh, "model_id", "language", static.languages, "code", "language_id"),
        "dds.bridge_models_libraries": bridges.code_bridge(
            fresh, "model_id", "library", static.libraries, "name", "library_id", by_slug),
        "dds.bridge_models_tasks": bridges.code_bridge(
            fresh, "model_id", "task", static.tasks, "name", "task_id", by_slug),
        "dds.bridge_models_datasets": bridges.name_bridge(
            fresh, "model_id", "dataset", "dataset_id"),
    }
    datasets = dimensions.with_name_key(distinct_elements(rows, "dataset"))
    return Load(
        loaded_at,
        versions={"dds.parties": party_change, "dds.dim_models": change},
        rows={"dds.dim_datasets": datasets, **pairs},
        facts={"dds.fact_models_metrics": metrics},
        rejects=rejects.select(F.lit("models").alias("entity"), F.col("name").alias("key"), "reason"),
    )


def papers_load(
    batch: DataFrame,
    parties: DataFrame,
    static: StaticDimensions,
    loaded_at: dt.datetime,
    order: Sequence[str],
) -> Load:
    """Papers are inserted once; their bridges grow with every load."""
    rows = stored(latest_by_key(batch, ["id"], order).select(
        F.col("id").alias("source_id"), md5_key(F.col("id")).alias("id"),
        F.coalesce("title", F.lit("")).alias("title"),
        "summary", "upvotes", "comments", "ai_summary", "published_at", "submitted_at",
        strip_to_null(F.col("submitted_by")).alias("submitted_by"),
        strip_to_null(F.col("organization")).alias("organization"),
        or_empty(F.col("authors")).alias("authors"),
        or_empty(F.col("ai_keywords")).alias("ai_keywords"),
    ), "load-rows")
    party_change = apply_versions(parties, one_per_name(paper_parties(rows)), "name", loaded_at)
    live = party_change.spoken
    # Every submitter is a party by now, so a row's own columns decide on its fate.
    keyed = with_calendar(rows, static.date, "published_at", "publish_")
    accepted, rejects = split_rejects(
        with_calendar(keyed, static.date, "submitted_at", "submitted_"),
        reasons(
            no_submitter=F.col("submitted_by").isNotNull(),
            no_submitted_date=F.col("submitted_date_id").isNotNull(),
        ),
    )
    papers = with_party_id(accepted.drop("authors", "ai_keywords"), live, "submitted_by", "submitted_by_id")
    papers = with_party_id(papers, live, "organization", "organization_id").select(
        "id", "source_id", "title", "summary", "upvotes", "comments", "submitted_by_id",
        "organization_id", "ai_summary", "publish_date_id", "publish_time_id",
        "submitted_date_id", "submitted_time_id",
    )
    linked = accepted.select(F.col("id").alias("paper_id"), "authors", "ai_keywords")
    return Load(
        loaded_at,
        versions={"dds.parties": party_change},
        rows={
            "dds.dim_authors": dimensions.with_name_key(distinct_elements(rows, "authors")),
            "dds.dim_keywords": dimensions.with_name_key(distinct_elements(rows, "ai_keywords")),
            "dds.dim_papers": papers,
            "dds.bridge_papers_authors": bridges.name_bridge(
                linked, "paper_id", "authors", "author_id"),
            "dds.bridge_papers_keywords": bridges.name_bridge(
                linked, "paper_id", "ai_keywords", "keyword_id"),
        },
        facts={},
        rejects=rejects.select(
            F.lit("papers").alias("entity"), F.col("source_id").alias("key"), "reason"),
    )


def prepared_posts(batch: DataFrame) -> DataFrame:
    return batch.withColumn("author", strip_to_null(F.col("author"))).withColumn(
        "hashdiff", post_hash()
    )


def posts_load(
    batch: DataFrame,
    parties: DataFrame,
    posts: DataFrame,
    static: StaticDimensions,
    loaded_at: dt.datetime,
    order: Sequence[str],
) -> Load:
    """``parties`` and ``posts`` are the live versions before the load."""
    rows = stored(prepared_posts(latest_by_key(batch, ["slug"], order)), "load-rows")
    party_change = apply_versions(parties, one_per_name(post_parties(rows)), "name", loaded_at)
    live = party_change.spoken

    dated = with_calendar(rows, static.date, "published_at", "publish_")
    accepted, rejects = split_rejects(
        with_calendar(dated, static.date, "updated_at", "update_"),
        reasons(
            no_author=F.col("author").isNotNull(),
            no_publish_date=F.col("publish_date_id").isNotNull(),
        ),
    )
    incoming = with_party_id(
        accepted.select(
            "slug", "author", F.coalesce("content_raw", F.lit("")).alias("content_raw"),
            "publish_date_id", "publish_time_id", "update_date_id", "update_time_id", "hashdiff",
        ),
        live, "author", "author_id", how="inner",
    ).drop("author")
    change = apply_versions(posts, incoming, "slug", loaded_at)
    known = stored(rows.join(entity_ids(change, "slug", "post_id"), "slug"), "load-posts")

    at = F.lit(loaded_at)
    hour = [date_id(at).alias("date_id"), time_id(at).alias("time_id")]
    metrics = known.select(
        "post_id",
        safe_int(F.col("total_unique_impressions")).alias("total_unique_impressions"),
        safe_int(F.col("num_comments")).alias("num_comments"),
        reaction_total(F.col("reactions")).alias("num_reactions"),
        *hour,
    )
    given = with_code_id(
        explode_reactions(known, ["post_id"]), static.reactions, "reaction", "reaction",
        "reaction_id",
    )
    reacted = (
        with_party_id(given, live, "user_name", "user_id", how="inner")
        .select("post_id", "reaction_id", "user_id", *hour)
        .distinct()
    )
    return Load(
        loaded_at,
        versions={"dds.parties": party_change, "dds.dim_posts": change},
        rows={"dds.fact_posts_reactions": reacted},
        facts={"dds.fact_posts_metrics": metrics},
        rejects=rejects.select(F.lit("posts").alias("entity"), F.col("slug").alias("key"), "reason"),
    )


def commit(warehouse: Warehouse, load: Load, writers: int = 4) -> None:
    """Store a load: facts and rows first, then the dimensions they were read from.

    The ledger has a note of the load before the first write and one after the last, so
    readers of ``ledger.visible`` see all of it or nothing.  Every step is keyed, so a run
    that died can be repeated as a whole: ids do not depend on the run, and the live
    versions it started from are replaced last.  Tables that do not depend on each other
    are written side by side.
    """
    ledger, tables = Ledger(warehouse), [*load.facts, *load.rows, *load.versions]
    ledger.note(load.loaded_at, BEGUN, tables)
    days: dict[str, list[int]] = {}

    def store_fact(name: str) -> None:
        key = table(name).key
        days[name] = partition_values(load.facts[name], "date_id")
        touched = touched_partitions(
            warehouse.frame(name), load.facts[name], key, key, "date_id", days[name]
        )
        warehouse.commit_partitions(touched, name)

    def store_rows(name: str) -> None:
        key = table(name).unique or table(name).key
        warehouse.append(new_rows(warehouse.frame(name), load.rows[name], key), name)

    with ThreadPoolExecutor(writers) as pool:
        jobs = [pool.submit(store_fact, name) for name in load.facts]
        jobs += [pool.submit(store_rows, name) for name in load.rows]
        for job in jobs:
            job.result()
    # The party versions are read by the other dimensions, so they go last.
    for name in sorted(load.versions, key=lambda n: n == "dds.parties"):
        warehouse.commit_versions(load.versions[name], name, load.loaded_at)
    ledger.note(load.loaded_at, ENDED, tables, set().union(*days.values()))


def store_static(warehouse: Warehouse, static: StaticDimensions) -> None:
    """Add the rows the static dimensions lack."""
    for name, rows in static.by_table().items():
        key = table(name).unique
        warehouse.append(insert_ignore(warehouse.frame(name), rows, key), name)
