"""Incremental loads, replays and hourly rollups."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.records import project_posts
from ...operators import latest, versions
from ...schemas import RAW_POST
from ...session import fresh_dir
from ...sources.staging import write_staged_json
from ...sources.tables import Warehouse
from ...streaming import incremental
from .. import flows
from ..given import POST_LOAD, Given
from ..registry import query, stamp, stamp_sql
from .columns import POST_HASH_SQL
from .joins import no_rows
from .version_sql import versions_sql

_UTC = dt.timezone.utc
# The post feed lands in this many loads of equal time spans.
_LOADS = 3

_STREAM_ROWS = {
    "stream_span": f"""
        SELECT min(CAST(epoch(loaded_at) AS BIGINT)) AS low,
          (max(CAST(epoch(loaded_at) AS BIGINT)) - min(CAST(epoch(loaded_at) AS BIGINT)))
            // {_LOADS} + 1 AS width FROM ods_posts""",
    "stream_rows": f"""
        SELECT *, {POST_HASH_SQL} AS hashdiff FROM (
          SELECT p.* REPLACE (nullif(trim(author), '') AS author,
            TIMESTAMP '1970-01-01' + to_seconds(low + width * (1 + coalesce(
              (CAST(epoch(loaded_at) AS BIGINT) - low) // width, {_LOADS - 1}))) AS loaded_at)
          FROM ods_posts p, stream_span)
        WHERE author IS NOT NULL AND published_at >= TIMESTAMP '2000-01-01'""",
}


@query(
    f"""
    SELECT id, slug, hashdiff, is_current, {stamp_sql('valid_from')} AS valid_from,
      {stamp_sql('valid_to')} AS valid_to FROM stream_rows_versions""",
    {**_STREAM_ROWS, **versions_sql("stream_rows", "slug", "content_raw", "position DESC")},
)
def stream_ods_to_dds(g: Given) -> DataFrame:
    """The post feed in landed loads of equal time spans, streamed into a fresh warehouse."""
    landing = fresh_dir(g.spark, "landing")
    at = F.unix_seconds("loaded_at")
    feed = g.post_feed
    low, high = feed.agg(F.min(at), F.max(at)).first()
    low, high = low or 0, high or 0
    width = (high - low) // _LOADS + 1
    place = F.coalesce(F.floor((at - low) / width), F.lit(_LOADS - 1))
    for load in range(_LOADS):
        moment = dt.datetime.fromtimestamp(low + width * (load + 1), _UTC)
        part = feed.where(place == load).drop("loaded_at")
        write_staged_json(part, landing, "posts", "raw", incremental.folder_time(moment))
    home = Warehouse(g.spark, fresh_dir(g.spark, "warehouse"), f"trial_{uuid.uuid4().hex[:8]}_")
    home.init_tables(["dds"])
    static = flows.StaticDimensions.generate(g.spark)

    def apply(raw: DataFrame, moment: dt.datetime) -> None:
        store = Warehouse(raw.sparkSession, home.root, home.prefix)
        load = flows.posts_load(
            project_posts(raw), store.live("dds.parties"), store.live("dds.dim_posts"), static,
            moment, ["position"],
        )
        flows.commit(store, load)

    stream = incremental.landed_stream(
        g.spark, f"{landing}/entity=posts/stage=raw", f"{RAW_POST}, position long"
    )
    incremental.apply_loads(stream, apply, fresh_dir(g.spark, "progress")).awaitTermination()
    home.refresh("dds.dim_posts")
    built = g.stored(home.frame("dds.dim_posts"), "dim-posts")
    home.drop(["dds"])
    return built.select(
        "id", "slug", "hashdiff", "is_current", stamp("valid_from").alias("valid_from"),
        stamp("valid_to").alias("valid_to"),
    )


@query(
    f"""
    SELECT slug, {POST_HASH_SQL} AS hashdiff, 0::BIGINT AS replay_changes FROM (
      SELECT * REPLACE (nullif(trim(author), '') AS author) FROM ods_posts
      QUALIFY row_number() OVER (PARTITION BY slug ORDER BY loaded_at DESC, position DESC) = 1)""")
def idempotent_replay(g: Given) -> DataFrame:
    """One load applied twice: the second time nothing is inserted or ended."""
    rows = flows.prepared_posts(
        latest.latest_by_key(g.posts, ["slug"], ["loaded_at", "position"])
    ).select("slug", "content_raw", "hashdiff")
    empty = no_rows(g, "dds.dim_posts").select(*rows.columns, *versions.VERSION_COLUMNS)
    once = versions.apply_versions(empty, rows, "slug", POST_LOAD)
    twice = versions.apply_versions(once.current, rows, "slug", POST_LOAD)
    changes = twice.inserted.unionByName(twice.closed).agg(F.count(F.lit(1)).alias("n"))
    return twice.current.select("slug", "hashdiff", changes.scalar().alias("replay_changes"))


_ROLLUP_SQL = f"""
    SELECT user_id, {stamp_sql("date_trunc('hour', ts)")} AS hour, event_id, event_type, value
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts)
      ORDER BY ts DESC, event_id DESC) = 1"""


@query(_ROLLUP_SQL)
def hourly_rollup_latest(g: Given) -> DataFrame:
    rolled = latest.hourly_latest(g.table("events"), ["user_id"], "ts", ["event_id"])
    return rolled.select("user_id", stamp("hour").alias("hour"), "event_id", "event_type", "value")


@query(_ROLLUP_SQL)
def hourly_rollup_stream(g: Given) -> DataFrame:
    """The same over the events read as a stream, with open hours as state."""
    schema = g.table("events").schema
    stream = incremental.table_stream(g.spark, g.sf_dir, "events", schema)
    path = fresh_dir(g.spark, "rollup")
    incremental.hourly_upserts(
        stream, ["user_id"], "ts", ["event_id"], path, fresh_dir(g.spark, "progress")
    ).awaitTermination()
    final = incremental.read_hourly(g.spark, path, schema)
    return final.select("user_id", stamp("hour").alias("hour"), "event_id", "event_type", "value")
