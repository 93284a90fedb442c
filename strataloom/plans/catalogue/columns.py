"""Projections and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import keys, numbers, text
from ...functions.html import linked_ids
from ...functions.moments import date_text, hour_text, parse_iso
from ...functions.records import project_models, submitter_name
from ...functions.tags import TagVocabulary, extract_owner
from ...operators.flatten import parse_reactions
from ...operators.parties import owner_types
from ...sources.tables import pick_columns
from ..given import Given
from ..registry import as_double, listed, query, stamp, stamp_sql

_TAG_LISTS = ("language", "library", "task", "base_models", "dataset")
_TAG_TEXTS = ("license", "modification", "region", "diffusers_pipeline", "deploy")
_LISTS_SQL = ", ".join(f"array_to_string({c}, ',') AS {c}" for c in _TAG_LISTS)


def _tag_columns(models: DataFrame) -> DataFrame:
    return models.select(
        "id", "position", *[listed(c).alias(c) for c in _TAG_LISTS], *_TAG_TEXTS, "arxiv"
    )


@query(f"SELECT id, position, {_LISTS_SQL}, {', '.join(_TAG_TEXTS)}, arxiv FROM ods_models")
def classify_tags(g: Given) -> DataFrame:
    return _tag_columns(g.models)


@query("""
    SELECT position, CASE WHEN lower(tags[2]) = tags[2] THEN tags[2] END AS library,
      NULL::VARCHAR AS task FROM model_feed""")
def classify_tags_strict(g: Given) -> DataFrame:
    """Entries as the dictionary spells them: only those in lower case can match."""
    strict = TagVocabulary.standard(g.spark, strict=True)
    models = project_models(g.model_feed, strict)
    return models.select("position", listed("library").alias("library"), listed("task").alias("task"))


@query("""
    SELECT owner, count(*) AS n FROM ods_models GROUP BY 1""")
def extract_owner_of_models(g: Given) -> DataFrame:
    owners = g.model_feed.select(extract_owner(F.col("id")).alias("owner"))
    return owners.groupBy("owner").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    SELECT id, owner, {stamp_sql('created_at')} AS created_at, downloads, likes, library_name,
      pipeline_tag, trending_score, position FROM ods_models""")
def project_model(g: Given) -> DataFrame:
    return g.models.select(
        "id", "owner", stamp("created_at").alias("created_at"), "downloads", "likes",
        "library_name", "pipeline_tag", "trending_score", "position",
    )


@query(f"""
    SELECT id, array_to_string(authors, ',') AS authors, title, upvotes, comments, submitted_by,
      organization, {stamp_sql('published_at')} AS published_at, position FROM ods_papers""")
def project_paper(g: Given) -> DataFrame:
    return g.papers.select(
        "id", listed("authors").alias("authors"), "title", "upvotes", "comments", "submitted_by",
        "organization", stamp("published_at").alias("published_at"), "position",
    )


@query(f"""
    SELECT slug, author, content_raw, {stamp_sql('published_at')} AS published_at,
      {stamp_sql('updated_at')} AS updated_at, array_to_string(mentions, ',') AS mentions,
      array_to_string(attachments, ',') AS attachments, position FROM ods_posts""")
def project_post(g: Given) -> DataFrame:
    return g.posts.select(
        "slug", "author", "content_raw", stamp("published_at").alias("published_at"),
        stamp("updated_at").alias("updated_at"), listed("mentions").alias("mentions"),
        listed("attachments").alias("attachments"), "position",
    )


@query("""
    SELECT page_id, unnest(ids) AS paper_id, unnest(range(len(ids))) AS place FROM (
      SELECT page_id, ['2401.' || n, '2402.' || n] AS ids
      FROM (SELECT page_id, lpad(CAST(page_id % 100000 AS VARCHAR), 5, '0') AS n FROM page_feed))""")
def extract_page_ids(g: Given) -> DataFrame:
    """Paper ids linked from each page, first occurrence first."""
    return g.page_feed.select(
        "page_id", F.posexplode(linked_ids(F.col("html"))).alias("place", "paper_id")
    ).withColumn("place", F.col("place").cast("long"))


_HREF = """(?is)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)"""


@query(f"""
    SELECT page_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(
        regexp_extract_all(
          regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'),
          '{_HREF}', 1),
        lambda h: trim(string_split(trim(h, '"'''), '/')[-1], '/')),
        lambda w: regexp_matches(w, '^[A-Za-z]+$')))), ',') AS words
    FROM pages""")
def extract_page_words(g: Given) -> DataFrame:
    """The same extraction with another marker and pattern, on the pages as given."""
    words = linked_ids(F.col("html"), marker="/", id_pattern="^[A-Za-z]+$")
    return g.table("pages").select("page_id", listed(F.array_sort(words)).alias("words"))


@query("SELECT submitted_by, count(*) AS n FROM paper_feed GROUP BY 1")
def submitter_flatten(g: Given) -> DataFrame:
    feed = g.paper_feed
    return feed.groupBy(submitter_name(feed).alias("submitted_by")).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment, NULL::VARCHAR AS bad,
      NULL::VARCHAR AS undated,
      strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS shifted FROM events""")
def parse_iso_datetime(g: Given) -> DataFrame:
    """``Z`` and offset forms are instants; other text is NULL."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    undated = F.array(F.date_format("ts", "HH:mm:ss"), F.date_format("ts", "'T'HH"), F.date_format("ts", "yyyy"))
    return g.table("events").select(
        "event_id",
        stamp(parse_iso(F.concat(iso, F.lit(".000Z")))).alias("moment"),
        parse_iso(F.concat(F.lit("on "), iso)).cast("string").alias("bad"),
        parse_iso(F.get(undated, (F.col("event_id") % 3).cast("int"))).cast("string").alias("undated"),
        stamp(parse_iso(F.concat(iso, F.lit("+02:00")))).alias("shifted"),
    )


@query("""
    SELECT slug, position, strftime(updated_at, '%Y-%m-%d') AS date,
      strftime(updated_at, '%H') || ':00:00' AS time FROM ods_posts""")
def date_hour_keys(g: Given) -> DataFrame:
    moment = F.col("updated_at")
    return g.posts.select(
        "slug", "position", date_text(moment).alias("date"), hour_text(moment).alias("time")
    )


@query("""
    SELECT position, nullif(regexp_replace(regexp_replace(author, '^\\s+', ''), '\\s+$', ''), '')
      AS author FROM ods_posts""")
def strip_to_null(g: Given) -> DataFrame:
    return g.posts.select("position", text.strip_to_null(F.col("author")).alias("author"))


@query("""
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN 0
      ELSE CAST(trunc(value) AS BIGINT) END AS whole,
      9007199254740993 + event_id AS long_number FROM events""")
def safe_int(g: Given) -> DataFrame:
    """NULL and NaN, put in by turns, become 0."""
    third = F.col("event_id") % 3
    value = F.when(third == 1, F.lit(float("nan"))).when(third == 2, F.col("value"))
    return g.table("events").select(
        "event_id", numbers.safe_int(value).alias("whole"),
        numbers.safe_int(F.col("event_id") + 9007199254740993).alias("long_number"),
    )


MODEL_HASH_SQL = """md5(concat_ws('|', id, coalesce(owner, 'None'), coalesce(library_name, 'None'),
    coalesce(pipeline_tag, 'None'), coalesce(license, 'None'), coalesce(modification, 'None'),
    coalesce(region, 'None'), coalesce(diffusers_pipeline, 'None'), coalesce(deploy, 'None'),
    coalesce(array_to_string(list_sort(language), ','), 'None'),
    coalesce(array_to_string(list_sort(library), ','), 'None'),
    coalesce(array_to_string(list_sort(task), ','), 'None'),
    coalesce(array_to_string(list_sort(dataset), ','), 'None')))"""


@query(f"SELECT id, position, {MODEL_HASH_SQL} AS hashdiff FROM ods_models")
def hashdiff_model(g: Given) -> DataFrame:
    models = g.models.withColumn("name", F.col("id"))
    return models.select("id", "position", keys.model_hash().alias("hashdiff"))


POST_HASH_SQL = """md5(concat_ws('|', slug, coalesce(author, 'None'), coalesce(content_raw, 'None'),
    coalesce(strftime(published_at, '%Y-%m-%d|%H:00:00'), 'None|None'),
    coalesce(strftime(updated_at, '%Y-%m-%d|%H:00:00'), 'None|None')))"""


@query(f"SELECT slug, position, {POST_HASH_SQL} AS hashdiff FROM ods_posts")
def hashdiff_post(g: Given) -> DataFrame:
    return g.posts.select("slug", "position", keys.post_hash().alias("hashdiff"))


@query("SELECT s_name AS name, md5(s_name || '|' || s_nationkey) AS hashdiff FROM supplier")
def hashdiff_party(g: Given) -> DataFrame:
    return g.table("supplier").select(
        F.col("s_name").alias("name"),
        keys.party_hash(F.col("s_name"), F.col("s_nationkey")).alias("hashdiff"),
    )


@query("""
    SELECT doc_id, nullif(array_to_string(list_sort(string_split(source || ',' || lang, ',')), ';'), '')
      AS joined FROM documents""")
def sorted_array_join(g: Given) -> DataFrame:
    items = F.split(F.concat_ws(",", "source", "lang"), ",")
    return g.table("documents").select(
        "doc_id", F.replace(text.sorted_join(items), F.lit(","), F.lit(";")).alias("joined")
    )


@query("""
    SELECT coalesce(pipeline_tag, 'no_tag') AS tag, coalesce(license, 'no_license') AS license,
      count(*) AS n FROM dds_models GROUP BY ALL""")
def default_label(g: Given) -> DataFrame:
    return g.detail.models.groupBy(
        text.default_label(F.col("pipeline_tag"), "no_tag").alias("tag"),
        text.default_label(F.col("license"), "no_license").alias("license"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT id, coalesce(nullif(trim(upper(modification)), ''), 'ORIGINAL') AS modification_type
    FROM dds_models""")
def normalise_modification(g: Given) -> DataFrame:
    return g.detail.models.select(
        "id", text.modification_label(F.col("modification")).alias("modification_type")
    )


@query("""
    SELECT model_id, date_id, time_id, CAST(round(CAST(
      CASE WHEN downloads <> 0 THEN CAST(likes AS DOUBLE) / downloads END
      AS DECIMAL(38, 12)), 4) AS DOUBLE) AS ratio, downloads
    FROM dds_metrics""")
def likes_ratio(g: Given) -> DataFrame:
    ratio = numbers.likes_ratio(F.col("likes"), F.col("downloads"))
    return g.detail.metrics.select(
        "model_id", "date_id", "time_id", as_double(ratio).alias("ratio"), "downloads"
    )


@query("""
    SELECT l_orderkey, l_linenumber,
      CAST(CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28, 6)) AS DECIMAL(24, 3))
        AS DOUBLE) AS net FROM lineitem""")
def round_numeric(g: Given) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return g.table("lineitem").select(
        "l_orderkey", "l_linenumber", as_double(numbers.round_half_up(numbers.exact(net, 6), 3)).alias("net")
    )


@query("""
    SELECT c_custkey, upper(md5(c_name)) AS upper_key, CAST(CAST(md5(c_name) AS UUID) AS VARCHAR)
      AS uuid_key FROM customer""")
def md5_key(g: Given) -> DataFrame:
    name = F.col("c_name")
    return g.table("customer").select(
        "c_custkey", keys.md5_upper(name).alias("upper_key"), keys.md5_uuid(name).alias("uuid_key")
    )


@query("""
    SELECT DISTINCT owner AS name,
      CASE WHEN owner IN (SELECT name FROM known_users) THEN 'user' ELSE 'org' END AS type
    FROM ods_models WHERE owner IS NOT NULL""")
def owner_type(g: Given) -> DataFrame:
    owners = g.model_feed.select(extract_owner(F.col("id")).alias("name"))
    return owner_types(owners, g.known_users)


@query("""
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS reactions,
      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_guards(g: Given) -> DataFrame:
    """Text that is no reaction list, as every second one here, is NULL, shown as -1."""
    k = F.get_json_object("props", "$.k")
    good = F.concat(F.lit('[{"reaction":"r","users":["u"],"count":'), k, F.lit("}]"))
    either = F.when(F.col("event_id") % 2 == 0, good).otherwise(F.lit("text"))
    return g.table("events").select(
        "event_id",
        F.coalesce(F.size(parse_reactions(either)), F.lit(-1)).alias("reactions"),
        k.cast("int").alias("k"),
    )


@query("""
    SELECT id, position, len(authors) AS authors FROM ods_papers WHERE len(authors) > 0""")
def array_guard(g: Given) -> DataFrame:
    return g.papers.where(F.size("authors") > 0).select(
        "id", "position", F.size("authors").cast("long").alias("authors")
    )


@query("""
    SELECT event_type, count(*) FILTER (event_id % 3 <> 0) AS present, count(*) AS n
    FROM events GROUP BY 1""")
def null_to_none(g: Given) -> DataFrame:
    """NaN, put into every third value, counts as absent."""
    value = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return g.table("events").groupBy("event_type").agg(
        F.count(numbers.nan_to_null(value)).alias("present"), F.count(F.lit(1)).alias("n")
    )


@query("SELECT s_suppkey, s_name FROM supplier")
def pick_columns_of_supplier(g: Given) -> DataFrame:
    return pick_columns(g.table("supplier"), ["s_suppkey", "s_name"])


@query("SELECT position, CAST(to_json(reactions) AS VARCHAR) AS reactions FROM ods_posts")
def json_serialise(g: Given) -> DataFrame:
    return g.posts.select("position", F.to_json("reactions").alias("reactions"))
