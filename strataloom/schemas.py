"""Every table of the warehouse: columns, keys, references and limits.

Identifiers are digests (text), calendar keys are integers ``yyyymmdd`` and hours.
The constraints are not enforced on write; ``operators.quality.audit`` checks them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

REACTION_DDL = "array<struct<reaction: string, users: array<string>, count: int>>"

# Shapes of the landed JSON records, by entity.
RAW_MODEL = (
    "id string, created_at string, downloads long, likes long, trending_score double, "
    "library_name string, pipeline_tag string, tags array<string>"
)
RAW_PAPER = (
    "id string, authors array<string>, published_at string, title string, summary string, "
    "upvotes int, discussion_id string, source string, comments int, submitted_at string, "
    "submitted_by struct<username: string>, ai_summary string, ai_keywords array<string>, "
    "organization struct<name: string>"
)
RAW_POST = (
    "slug string, author struct<name: string>, rawContent string, publishedAt string, "
    "updatedAt string, totalUniqueImpressions long, numComments long, "
    f"reactions {REACTION_DDL}, mentions array<struct<name: string>>, "
    "attachments array<struct<type: string>>"
)
# Flat model records of the store comparison; deploy and arxiv are lists there.
BENCH_MODEL = (
    "id string, owner string, author string, created_at string, downloads long, likes int, "
    "library_name string, pipeline_tag string, trending_score double, "
    "language array<string>, library array<string>, task array<string>, license string, "
    "base_models array<string>, modification string, region string, "
    "diffusers_pipeline string, deploy array<string>, dataset array<string>, "
    "arxiv array<string>, loaded_at timestamp"
)


@dataclass(frozen=True)
class Table:
    """One table and the rules its rows must meet."""

    name: str
    columns: str
    key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    refs: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    versioned: bool = False

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def column_names(self) -> list[str]:
        return self.schema.fieldNames()


def _ods(name: str, columns: str) -> Table:
    return Table(f"ods.{name}", f"{columns}, loaded_at timestamp", partition_by=("loaded_at",))


def _bridge(name: str, left: str, left_table: str, right: str, right_table: str) -> Table:
    return Table(
        f"dds.{name}",
        f"{left} string, {right} string",
        key=(left, right),
        refs={left: left_table, right: right_table},
        required=(left, right),
    )


def _names(name: str, limit: int | None = 255) -> Table:
    return Table(
        f"dds.{name}",
        "id string, name string",
        key=("id",),
        unique=("name",),
        required=("id", "name"),
        max_length={"name": limit} if limit else {},
    )


_VERSION = "valid_from timestamp, valid_to timestamp, is_current boolean, hashdiff string"
_VERSION_REQUIRED = ("valid_from", "valid_to", "is_current", "hashdiff")
_CALENDAR = {"date_id": "dds.dim_date", "time_id": "dds.dim_time"}

ODS_TABLES = (
    _ods(
        "models",
        "id string, owner string, created_at timestamp, downloads long, likes int, "
        "library_name string, pipeline_tag string, trending_score double, "
        "language array<string>, library array<string>, task array<string>, license string, "
        "base_models array<string>, modification string, region string, "
        "diffusers_pipeline string, deploy string, dataset array<string>, arxiv int",
    ),
    _ods(
        "papers",
        "id string, authors array<string>, published_at timestamp, title string, "
        "summary string, upvotes int, discussion_id string, source string, comments int, "
        "submitted_at timestamp, submitted_by string, ai_summary string, "
        "ai_keywords array<string>, organization string",
    ),
    _ods(
        "posts",
        "slug string, author string, content_raw string, published_at timestamp, "
        "updated_at timestamp, total_unique_impressions int, num_comments int, "
        f"reactions {REACTION_DDL}, mentions array<string>, attachments array<string>",
    ),
)

DDS_TABLES = (
    Table(
        "dds.dim_date",
        "id int, date date, year int, month int, month_name string, day int, "
        "day_name string, week_day int, is_weekend boolean, quarter int, iso_week int",
        key=("id",),
        unique=("date",),
        required=("id", "date", "year", "month", "month_name", "day", "day_name",
                  "week_day", "is_weekend", "quarter"),
    ),
    Table(
        "dds.dim_time",
        "id int, time string, hour int, time_of_day string, is_business_hour boolean",
        key=("id",),
        unique=("hour",),
        required=("id", "time", "hour", "time_of_day", "is_business_hour"),
    ),
    Table(
        "dds.dim_languages",
        "id string, code string, name string",
        key=("id",),
        unique=("code",),
        required=("id", "code", "name"),
        max_length={"code": 255, "name": 255},
    ),
    _names("dim_libraries"),
    Table(
        "dds.dim_tasks",
        "id string, name string, type string",
        key=("id",),
        unique=("name",),
        required=("id", "name", "type"),
        max_length={"name": 255, "type": 255},
    ),
    Table(
        "dds.dim_reactions",
        "id string, reaction string",
        key=("id",),
        unique=("reaction",),
        required=("id", "reaction"),
        max_length={"reaction": 255},
    ),
    _names("dim_datasets"),
    _names("dim_authors"),
    _names("dim_keywords", limit=None),
    Table(
        "dds.parties",
        f"id string, name string, type string, {_VERSION}",
        key=("id",),
        required=("id", "name", "type", *_VERSION_REQUIRED),
        max_length={"name": 255},
        versioned=True,
    ),
    Table(
        "dds.dim_models",
        "id string, name string, owner_id string, library_name string, pipeline_tag string, "
        "license string, modification string, region string, diffusers_pipeline string, "
        f"deploy string, date_id int, time_id int, {_VERSION}",
        key=("id",),
        refs={"owner_id": "dds.parties", **_CALENDAR},
        required=("id", "name", "owner_id", "date_id", "time_id", *_VERSION_REQUIRED),
        versioned=True,
    ),
    Table(
        "dds.dim_papers",
        "id string, source_id string, title string, summary string, upvotes int, "
        "comments int, submitted_by_id string, organization_id string, ai_summary string, "
        "publish_date_id int, publish_time_id int, submitted_date_id int, "
        "submitted_time_id int",
        key=("id",),
        unique=("source_id",),
        refs={
            "submitted_by_id": "dds.parties", "organization_id": "dds.parties",
            "publish_date_id": "dds.dim_date", "publish_time_id": "dds.dim_time",
            "submitted_date_id": "dds.dim_date", "submitted_time_id": "dds.dim_time",
        },
        required=("id", "source_id", "title", "upvotes", "comments", "submitted_by_id",
                  "submitted_date_id", "submitted_time_id"),
    ),
    Table(
        "dds.dim_posts",
        "id string, slug string, author_id string, content_raw string, publish_date_id int, "
        f"publish_time_id int, update_date_id int, update_time_id int, {_VERSION}",
        key=("id",),
        refs={
            "author_id": "dds.parties",
            "publish_date_id": "dds.dim_date", "publish_time_id": "dds.dim_time",
            "update_date_id": "dds.dim_date", "update_time_id": "dds.dim_time",
        },
        required=("id", "slug", "author_id", "content_raw", "publish_date_id",
                  "publish_time_id", *_VERSION_REQUIRED),
        versioned=True,
    ),
    _bridge("bridge_models_languages", "model_id", "dds.dim_models",
            "language_id", "dds.dim_languages"),
    _bridge("bridge_models_libraries", "model_id", "dds.dim_models",
            "library_id", "dds.dim_libraries"),
    _bridge("bridge_models_tasks", "model_id", "dds.dim_models", "task_id", "dds.dim_tasks"),
    _bridge("bridge_models_datasets", "model_id", "dds.dim_models",
            "dataset_id", "dds.dim_datasets"),
    _bridge("bridge_papers_keywords", "paper_id", "dds.dim_papers",
            "keyword_id", "dds.dim_keywords"),
    _bridge("bridge_papers_authors", "paper_id", "dds.dim_papers",
            "author_id", "dds.dim_authors"),
    Table(
        "dds.fact_models_metrics",
        "model_id string, downloads long, likes long, trending_score double, "
        "date_id int, time_id int",
        key=("model_id", "date_id", "time_id"),
        refs={"model_id": "dds.dim_models", **_CALENDAR},
        required=("model_id", "downloads", "likes", "trending_score", "date_id", "time_id"),
        partition_by=("date_id",),
    ),
    Table(
        "dds.fact_posts_metrics",
        "post_id string, total_unique_impressions long, num_comments long, "
        "num_reactions long, date_id int, time_id int",
        key=("post_id", "date_id", "time_id"),
        refs={"post_id": "dds.dim_posts", **_CALENDAR},
        required=("post_id", "total_unique_impressions", "num_comments", "num_reactions",
                  "date_id", "time_id"),
        partition_by=("date_id",),
    ),
    Table(
        "dds.fact_posts_reactions",
        "post_id string, reaction_id string, user_id string, date_id int, time_id int",
        key=("post_id", "reaction_id", "user_id", "date_id", "time_id"),
        refs={"post_id": "dds.dim_posts", "reaction_id": "dds.dim_reactions",
              "user_id": "dds.parties", **_CALENDAR},
        required=("post_id", "reaction_id", "user_id", "date_id", "time_id"),
        partition_by=("date_id",),
    ),
)


def _mart(name: str, columns: str, **rules) -> Table:
    return Table(f"ads.{name}", f"{columns}, updated_at timestamp", **rules)


ADS_TABLES = (
    _mart("unique_top7d", "model_id string", key=("model_id",)),
    _mart("tag_pie", "pipeline_tag string, models_count long",
          key=("pipeline_tag",), required=("models_count",), max_length={"pipeline_tag": 100}),
    _mart("owners_treemap",
          "owner_name string, owner_type string, models_count long, "
          "avg_trending_score decimal(24,3), total_downloads long",
          key=("owner_name", "owner_type"), required=("models_count",),
          max_length={"owner_name": 255, "owner_type": 20}),
    _mart("trending_line",
          "trend_date date, avg_trending_score decimal(24,3), "
          "median_trending_score decimal(24,3), models_count long",
          key=("trend_date",), required=("avg_trending_score", "models_count")),
    _mart("leaderboard_30d",
          "rank_downloads int, model_name string, owner_name string, "
          "modification_type string, latest_downloads_30d long, latest_likes_30d long, "
          "likes_ratio decimal(24,4), latest_trending_score decimal(24,3)",
          key=("rank_downloads", "model_name"),
          required=("model_name", "owner_name", "latest_downloads_30d", "latest_likes_30d"),
          max_length={"owner_name": 255, "modification_type": 50}),
    _mart("license_histogram", "license string, models_count long",
          key=("license",), required=("models_count",), max_length={"license": 50}),
    _mart("modification_pie", "modification_type string, models_count long",
          key=("modification_type",), required=("models_count",),
          max_length={"modification_type": 50}),
)

TABLES = {t.name: t for t in (*ODS_TABLES, *DDS_TABLES, *ADS_TABLES)}


def table(name: str) -> Table:
    return TABLES[name]
