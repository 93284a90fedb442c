"""Scans, sinks and filters."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.moments import recent_days
from ...functions.records import project_posts
from ...functions.text import not_blank
from ...operators import marts
from ...operators.dimensions import distinct_dimension, distinct_values
from ...operators.lookups import keep_known, reasons, split_rejects
from ...schemas import BENCH_MODEL, RAW_POST, table
from ...session import fresh_dir
from ...sources import clustered, feed, staging, tables
from .. import flows
from ..given import AS_OF, PAPER_LOADS, Given
from ..registry import listed, query, stamp, stamp_sql

_UTC = dt.timezone.utc
BATCH = "20240201T000000"
POST_BATCH = "2024-01-15 10:00:00.000000"
MODEL_BATCH = "2005-06-15 03:00:00.000000"
FEED_NOW = dt.datetime(2024, 1, 20, 12, 0, tzinfo=_UTC)


def _staged(g: Given, df: DataFrame, entity: str) -> str:
    return staging.write_staged_json(df, fresh_dir(g.spark, "landing"), entity, "raw", BATCH)


@query(f"""
    SELECT slug, trim(author) AS author, content_raw, {stamp_sql('published_at')} AS published_at,
      num_comments, CAST(len(reactions) AS INTEGER) AS reactions, position
    FROM post_feed""")
def scan_staged_json(g: Given) -> DataFrame:
    path = _staged(g, g.post_feed, "posts")
    staged = staging.scan_staged_json(g.spark, path, f"{RAW_POST}, loaded_at string, position long")
    readable, _ = staging.split_corrupt(staged)
    return project_posts(readable).select(
        "slug", F.trim("author").alias("author"), "content_raw",
        stamp("published_at").alias("published_at"), "num_comments",
        F.size("reactions").alias("reactions"), "position",
    )


@query("""
    SELECT id, title, strftime(loaded_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS loaded_at, position
    FROM paper_feed""")
def write_staged_json(g: Given) -> DataFrame:
    path = _staged(g, g.paper_feed, "papers")
    return g.spark.read.schema("id string, title string, loaded_at string, position long").json(path)


@query(f"""
    SELECT id, {stamp_sql('published_at')} AS published_at,
      {stamp_sql('submitted_at')} AS submitted_at, position
    FROM paper_feed""")
def decode_datetimes(g: Given) -> DataFrame:
    decoded = staging.decode_datetimes(g.paper_feed, ["published_at", "submitted_at", "absent"])
    return decoded.select(
        "id", stamp("published_at").alias("published_at"),
        stamp("submitted_at").alias("submitted_at"), "position",
    )


def _bench_rows(g: Given) -> DataFrame:
    """Flat model records; list columns hold what the row form keeps as one value."""
    models = g.models
    return models.withColumns(
        {"author": F.col("owner"), "deploy": F.array("deploy"), "arxiv": F.array("pipeline_tag")}
    )


@query(f"""
    SELECT id, {stamp_sql('created_at')} AS created_at, downloads, likes, modification,
      {stamp_sql('loaded_at')} AS loaded_at
    FROM ods_models
    """)
def scan_jsonl_capped(g: Given) -> DataFrame:
    """All flat records of a JSON lines file; a cap is left to the caller of the reader."""
    path = _staged(g, _bench_rows(g), "bench")
    rows = staging.scan_json_lines(
        g.spark, path, BENCH_MODEL, ["created_at"],
    )
    return rows.select(
        "id", stamp("created_at").alias("created_at"), "downloads", "likes", "modification",
        stamp("loaded_at").alias("loaded_at"),
    )


@query(f"""
    SELECT id, owner, downloads, likes FROM ods_models
    WHERE loaded_at = TIMESTAMP '{MODEL_BATCH}'""")
def batch_scan_models(g: Given) -> DataFrame:
    return tables.batch_scan(g.models, MODEL_BATCH, ["id", "owner", "downloads", "likes"])


@query(f"""
    SELECT id, title, submitted_by FROM ods_papers
    WHERE loaded_at = TIMESTAMP '{PAPER_LOADS[0]:%Y-%m-%d}'""")
def batch_scan_papers(g: Given) -> DataFrame:
    return tables.batch_scan(g.papers, PAPER_LOADS[0], ["id", "title", "submitted_by"])


@query(f"""
    SELECT slug, content_raw, num_comments FROM ods_posts
    WHERE loaded_at = TIMESTAMP '{POST_BATCH}'""")
def batch_scan_posts(g: Given) -> DataFrame:
    return tables.batch_scan(g.posts, POST_BATCH, ["slug", "content_raw", "num_comments"])


@query(f"""
    SELECT loaded_at, count(*) AS n, count(id) AS ids, count(title) AS titles,
      CAST(sum(upvotes) AS BIGINT) AS upvotes
    FROM (SELECT * REPLACE ({stamp_sql('loaded_at')} AS loaded_at) FROM ods_papers) GROUP BY 1""")
def ods_append_nullable(g: Given) -> DataFrame:
    """Two loads appended one after the other; the second is sent twice."""
    path = fresh_dir(g.spark, "ods-papers")
    for moment in (*PAPER_LOADS, PAPER_LOADS[1]):
        load = tables.batch_scan(g.papers, moment)
        tables.append_batch(tables.nullable_rows(load, table("ods.papers")), path, moment)
    stored = g.spark.read.schema(table("ods.papers").columns).parquet(path)
    return stored.groupBy(stamp("loaded_at").alias("loaded_at")).agg(
        F.count(F.lit(1)).alias("n"), F.count("id").alias("ids"), F.count("title").alias("titles"),
        F.sum("upvotes").alias("upvotes"),
    )


@query("""
    SELECT slug, r.reaction AS reaction, r.count AS count, len(r.users) AS users, count(*) AS n
    FROM (SELECT slug, unnest(reactions) AS r FROM ods_posts) GROUP BY ALL""")
def ods_append_document(g: Given) -> DataFrame:
    path = fresh_dir(g.spark, "documents-posts")
    tables.append_batch(tables.document_rows(g.posts).drop("loaded_at"), path, FEED_NOW)
    nested = g.spark.read.parquet(path).select(
        "document.slug", F.explode("document.reactions").alias("r")
    )
    return nested.groupBy(
        "slug", F.col("r.reaction").alias("reaction"), F.col("r.count").alias("count"),
        F.size("r.users").cast("long").alias("users"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT slug, coalesce(total_unique_impressions, 0) AS total_unique_impressions,
      coalesce(num_comments, 0) AS num_comments, CAST(to_json(reactions) AS VARCHAR) AS reactions,
      array_to_string(mentions, ',') AS mentions
    FROM ods_posts""")
def ods_append_normalised(g: Given) -> DataFrame:
    path = fresh_dir(g.spark, "columnar-posts")
    rows = tables.normalised_rows(g.posts, table("ods.posts"))
    clustered.append_sorted(rows.drop("loaded_at"), path, FEED_NOW, ["slug"])
    return g.spark.read.parquet(path).select(
        "slug", "total_unique_impressions", "num_comments", "reactions",
        listed("mentions").alias("mentions"),
    )


@query("""
    SELECT unnest(['rows', 'documents', 'columnar']) AS form, count(*) AS n FROM ods_papers""")
def fan_out_sinks(g: Given) -> DataFrame:
    paths = tables.fan_out(g.papers, "papers", fresh_dir(g.spark, "fan-out"), FEED_NOW)
    stored = [
        g.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(form).alias("form"), "n")
        for form, path in paths.items()
    ]
    return stored[0].unionByName(stored[1]).unionByName(stored[2])


@query("""
    SELECT coalesce(license, 'no_license') AS license, count(*) AS models_count,
      '2005-06-30 00:00:00' AS updated_at
    FROM unique_recent JOIN dds_models ON model_id = id GROUP BY 1""")
def mart_overwrite(g: Given) -> DataFrame:
    """A mart written twice; the second content replaces the first."""
    path = fresh_dir(g.spark, "mart")
    unique = marts.unique_recent(g.detail, AS_OF)
    moment = dt.datetime.combine(AS_OF, dt.time(), _UTC)
    empty = g.detail.models.limit(0).selectExpr("license", "1L AS models_count")
    for content in (empty, marts.license_histogram(g.detail, unique)):
        tables.overwrite_mart(content, "license_histogram", path, moment)
    return g.spark.read.parquet(path).select(
        "license", "models_count", stamp("updated_at").alias("updated_at")
    )


@query("""
    SELECT 'dds.dim_papers' AS table_name, count(DISTINCT id) AS n FROM ods_papers
      WHERE submitted_at IS NOT NULL
    UNION ALL SELECT 'dds.dim_authors', count(DISTINCT a)
      FROM (SELECT unnest(authors) AS a FROM ods_papers)
    UNION ALL SELECT 'dds.dim_keywords', count(DISTINCT k)
      FROM (SELECT unnest(ai_keywords) AS k FROM ods_papers)
    UNION ALL SELECT 'dds.bridge_papers_authors', count(DISTINCT (id, a))
      FROM (SELECT id, unnest(authors) AS a FROM ods_papers WHERE submitted_at IS NOT NULL)
    UNION ALL SELECT 'dds.bridge_papers_keywords', count(DISTINCT (id, k))
      FROM (SELECT id, unnest(ai_keywords) AS k FROM ods_papers WHERE submitted_at IS NOT NULL)""")
def init_tables(g: Given) -> DataFrame:
    """A fresh warehouse, filled by two loads of papers, the second one twice."""
    home = tables.Warehouse(
        g.spark, fresh_dir(g.spark, "warehouse"), prefix=f"trial_{uuid.uuid4().hex[:8]}_"
    )
    home.init_tables(["dds"])
    static = flows.StaticDimensions.generate(g.spark)
    for moment in (*PAPER_LOADS, PAPER_LOADS[1]):
        batch = tables.batch_scan(g.papers, moment)
        load = flows.papers_load(batch, home.live("dds.parties"), static, moment, ["position"])
        flows.commit(home, load)
    names = [
        "dds.dim_papers", "dds.dim_authors", "dds.dim_keywords", "dds.bridge_papers_authors",
        "dds.bridge_papers_keywords",
    ]
    counts = [
        home.frame(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")
        for n in names
    ]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    total = g.stored(total, "counts")
    home.drop(["dds"])
    return total


@query("""
    SELECT DISTINCT modification, md5(modification) AS modification_id FROM dds_models
    WHERE modification IS NOT NULL AND modification <> ''""")
def ctas_distinct_dim(g: Given) -> DataFrame:
    return distinct_dimension(g.detail.models, "modification")


@query("""
    SELECT DISTINCT modification FROM dds_models WHERE modification IS NULL OR modification <> ''""")
def mongo_dim_distinct(g: Given) -> DataFrame:
    """Distinct values in the document store's sense: NULL is a value, empty text is not."""
    return distinct_values(g.detail.models, "modification")


# -- filters ----------------------------------------------------------------


@query("""
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = TIMESTAMP '1998-10-03'""")
def filter_batch(g: Given) -> DataFrame:
    moment = dt.datetime(1998, 10, 3, tzinfo=_UTC)
    loads = g.table("orders").withColumnRenamed("o_orderdate", "loaded_at")
    return tables.batch_scan(loads, moment, ["o_orderkey", "o_custkey"])


@query("""
    SELECT look_back, count(*) AS n FROM (
      SELECT unnest([7, 30]) AS look_back, CAST(ts AS DATE) AS day FROM events)
    WHERE day BETWEEN DATE '2024-01-20' - look_back AND DATE '2024-01-20' GROUP BY 1""")
def filter_recent_days(g: Given) -> DataFrame:
    days = g.table("events").select(F.to_date("ts").alias("day"))
    sides = [
        days.where(recent_days(F.col("day"), FEED_NOW.date(), n))
        .agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("look_back"), "n")
        for n in (7, 30)
    ]
    return sides[0].unionByName(sides[1])


@query("SELECT id, name FROM dds_models WHERE is_current")
def filter_current(g: Given) -> DataFrame:
    return g.detail.models.where("is_current").select("id", "name")


@query("""
    SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 0 GROUP BY 1""")
def filter_positive(g: Given) -> DataFrame:
    return g.table("orders").where("o_totalprice > 0").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
    SELECT 'both' AS form, count(*) AS n FROM dds_models
      WHERE modification IS NOT NULL AND modification <> ''
    UNION ALL SELECT 'null', count(*) FROM dds_models WHERE modification IS NOT NULL
    UNION ALL SELECT 'empty', count(*) FROM dds_models
      WHERE modification IS NULL OR modification <> ''""")
def filter_not_blank(g: Given) -> DataFrame:
    value = F.col("modification")
    forms = {
        "both": not_blank(value),
        "null": not_blank(value, drop_empty=False),
        "empty": not_blank(value, drop_null=False),
    }
    counts = g.detail.models.agg(*[F.count_if(f).alias(n) for n, f in forms.items()])
    return counts.unpivot([], list(forms), "form", "n")


@query("""
    SELECT slug, position FROM post_feed
    WHERE loaded_at >= TIMESTAMP '2024-01-19 12:00:00'""")
def filter_recent_feed(g: Given) -> DataFrame:
    items = g.post_feed.select("slug", "position", "loaded_at")
    return feed.recent_feed(items, FEED_NOW, F.col("loaded_at"), "position").drop("loaded_at")


@query("""
    SELECT position FROM (
      SELECT position, moment, row_number() OVER (ORDER BY moment DESC, position) AS place,
        count(*) FILTER (moment >= TIMESTAMP '2024-01-19 12:00:00') OVER () AS recent
      FROM (SELECT event_id AS position, ts AS moment FROM events))
    WHERE place <= 10 * (recent // 10 + 1)""")
def filter_recent_feed_pages(g: Given) -> DataFrame:
    """Whole pages up to the first one that ends with an old item."""
    items = g.table("events").select(F.col("event_id").alias("position"), "ts")
    return feed.recent_feed(items, FEED_NOW, F.col("ts"), "position", exact=False).drop("ts")


@query("""
    SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def filter_in_list(g: Given) -> DataFrame:
    orders = g.table("orders").select(F.col("o_custkey").alias("c_custkey"))
    return keep_known(g.table("customer").select("c_custkey"), orders, "c_custkey")


@query("""
    SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS n FROM (
      SELECT CASE WHEN owner IS NULL THEN 'no_owner'
        WHEN created_at < TIMESTAMP '2000-01-01' THEN 'no_created_date' END AS reason
      FROM ods_models) GROUP BY 1""")
def reject_incomplete(g: Given) -> DataFrame:
    in_calendar = F.col("created_at") >= F.lit(dt.datetime(2000, 1, 1, tzinfo=_UTC))
    accepted, rejects = split_rejects(
        g.models, reasons(no_owner=F.col("owner").isNotNull(), no_created_date=in_calendar)
    )
    outcome = accepted.select(F.lit("accepted").alias("outcome")).unionByName(
        rejects.select(F.col("reason").alias("outcome"))
    )
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
