"""Versioned dimensions, upserts, insert-only tables and bridges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.keys import model_hash, version_key
from ...functions.moments import date_id
from ...operators import dimensions, latest, parties, versions
from ...operators.lookups import with_calendar
from .. import flows
from ..given import (
    MODEL_CUT,
    MODEL_LOAD,
    MODEL_ORDER,
    PAPER_LOADS,
    POST_CUT,
    POST_LOAD,
    SHIFT_DAYS,
    Given,
)
from ..registry import query, stamp, stamp_sql
from .joins import no_rows, post_versions
from .version_sql import (
    MODEL_ORDER_SQL,
    MODEL_ROWS,
    MODEL_VERSIONS,
    POST_ROWS,
    POST_VERSIONS,
    versions_sql,
)

_UTC = dt.timezone.utc


def _text(moment: dt.datetime) -> str:
    return moment.strftime("%Y-%m-%d %H:%M:%S")


# -- versions ---------------------------------------------------------------


def accepted_models(g: Given) -> DataFrame:
    """Model rows the detail layer accepts, without what comes from their tags."""
    heads = with_calendar(flows.named_models(g.model_heads), g.dates, "created_at")
    return heads.where("owner IS NOT NULL AND date_id IS NOT NULL").drop(
        "id", "created_at", "date_id", "time_id"
    )


def hashed_models(g: Given, accepted: DataFrame) -> DataFrame:
    """Accepted rows with the attributes of their tags and the change hash."""
    return g.whole_models(accepted).withColumn("hashdiff", model_hash()).select(
        "name", "owner", "license", "hashdiff", *MODEL_ORDER
    )


def model_rows(g: Given) -> DataFrame:
    """Model rows the detail layer accepts, with their change hash."""
    return hashed_models(g, accepted_models(g))


_VERSION_OUT = ("valid_from", "valid_to")


def _shown(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, *[stamp(c).alias(c) for c in _VERSION_OUT], "is_current")


@query(
    f"""
    SELECT name, owner, license, hashdiff, {stamp_sql('valid_from')} AS valid_from,
      {stamp_sql('valid_to')} AS valid_to, is_current FROM model_rows_versions""",
    MODEL_VERSIONS,
)
def scd2_versions(g: Given) -> DataFrame:
    """Every version of every model over the whole history of loads."""
    built = versions.rebuild_versions(model_rows(g), "name", order=MODEL_ORDER[1:])
    return _shown(built, "name", "owner", "license", "hashdiff")


def _applied(
    g: Given,
    rows: DataFrame,
    key: str,
    order: tuple[str, ...],
    cut: dt.datetime,
    whole: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Live and ended versions after one load of all rows since ``cut`` onto the history
    before; the load is dated by its newest row.  The rows are derived once and stored.

    ``whole`` adds what ``rows`` lack, row by row: to the history, and to the load after it
    is reduced.
    """
    rows = g.stored(rows, "version-rows")
    newest = rows.select(F.date_format(F.max("loaded_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    load = dt.datetime.fromisoformat(newest).replace(tzinfo=_UTC) if newest else cut
    before = whole(rows.where(F.col("loaded_at") < F.lit(cut)))
    live = g.stored(
        versions.rebuild_versions(before, key, order=order).where("is_current"), "live-versions"
    )
    after = rows.where(F.col("loaded_at") >= F.lit(cut))
    incoming = whole(latest.latest_by_key(after, [key], ["loaded_at", *order]))
    change = versions.apply_versions(live, incoming, key, load)
    return change.current.unionByName(change.closed)


def _applied_sql(rows: str, key: str, attribute: str) -> str:
    at = f"(SELECT max(loaded_at) FROM {rows})"
    return f"""
        SELECT {key}, {attribute}, hashdiff, is_current, {stamp_sql('valid_from')} AS valid_from,
          {stamp_sql('valid_to')} AS valid_to
        FROM (
          SELECT l.{key}, l.{attribute}, l.hashdiff, l.valid_from,
            CASE WHEN i.hashdiff <> l.hashdiff THEN {at} ELSE l.valid_to END AS valid_to,
            i.hashdiff IS NULL OR i.hashdiff = l.hashdiff AS is_current
          FROM (SELECT * FROM {rows}_versions WHERE is_current) l
            LEFT JOIN incoming i USING ({key})
          UNION ALL
          SELECT i.{key}, i.{attribute}, i.hashdiff, {at}, {at} + to_days(36500), true
          FROM incoming i LEFT JOIN (SELECT * FROM {rows}_versions WHERE is_current) l USING ({key})
          WHERE l.hashdiff IS DISTINCT FROM i.hashdiff)"""


def _incoming_sql(rows: str, key: str, order: str, cut: dt.datetime) -> dict:
    return {"incoming": f"""
        SELECT * FROM {rows} WHERE loaded_at >= TIMESTAMP '{_text(cut)}'
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY loaded_at DESC, {order}) = 1"""}


@query(
    _applied_sql("model_rows", "name", "license"),
    {
        **MODEL_ROWS,
        **versions_sql("model_rows", "name", "license", MODEL_ORDER_SQL, _text(MODEL_CUT)),
        **_incoming_sql("model_rows", "name", MODEL_ORDER_SQL, MODEL_CUT),
    },
)
def scd2_models(g: Given) -> DataFrame:
    applied = _applied(
        g, accepted_models(g), "name", MODEL_ORDER[1:], MODEL_CUT, lambda rows: hashed_models(g, rows)
    )
    return _shown(applied, "name", "license", "hashdiff")


@query(
    _applied_sql("post_rows", "slug", "content_raw"),
    {
        **POST_ROWS,
        **versions_sql("post_rows", "slug", "content_raw", "position DESC", _text(POST_CUT)),
        **_incoming_sql("post_rows", "slug", "position DESC", POST_CUT),
    },
)
def scd2_posts(g: Given) -> DataFrame:
    rows = flows.prepared_posts(g.posts).select(
        "slug", "content_raw", "hashdiff", "loaded_at", "position"
    )
    return _shown(
        _applied(g, rows, "slug", ("position",), POST_CUT), "slug", "content_raw", "hashdiff"
    )


_PARTY_LOADS = (
    dt.datetime(2024, 3, 1, tzinfo=_UTC), dt.datetime(2024, 3, 2, tzinfo=_UTC),
)


@query(f"""
    WITH first AS (
      SELECT c_name AS name,
        CASE WHEN c_mktsegment = 'BUILDING' OR c_nationkey = 3 THEN 'org' ELSE 'user' END AS type
      FROM customer),
    second AS (
      SELECT c_name AS name, CASE WHEN c_custkey % 7 = 0 THEN
          CASE WHEN c_mktsegment = 'BUILDING' THEN 'user' ELSE 'org' END
        WHEN c_mktsegment = 'BUILDING' THEN 'org' ELSE 'user' END AS type FROM customer
      UNION ALL SELECT s_name, 'org' FROM supplier)
    SELECT name, type, is_current, md5(name || '|' || started) AS id, started AS valid_from FROM (
      SELECT f.name, f.type, s.type = f.type AS is_current,
        '2024-03-01 00:00:00.000000' AS started FROM first f JOIN second s USING (name)
      UNION ALL
      SELECT s.name, s.type, true, '2024-03-02 00:00:00.000000'
      FROM second s LEFT JOIN first f USING (name) WHERE s.type IS DISTINCT FROM f.type)""")
def scd2_parties(g: Given) -> DataFrame:
    """Two loads: types of some customers change, suppliers are new, one nation is both."""
    customers = g.table("customer")
    building = F.col("c_mktsegment") == "BUILDING"
    kind = F.when(building, "org").otherwise("user")
    flipped = F.when(building, "user").otherwise("org")
    everyone = customers.select(F.col("c_name").alias("name"), kind.alias("type"))
    also_org = customers.where("c_nationkey = 3").select(
        F.col("c_name").alias("name"), F.lit("org").alias("type")
    )
    second = customers.select(
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 7 == 0, flipped).otherwise(kind).alias("type"),
    )
    suppliers = g.table("supplier").select(F.col("s_name").alias("name"), F.lit("org").alias("type"))
    loaded = versions.apply_versions(
        no_rows(g, "dds.parties"), parties.one_per_name(everyone, also_org), "name", _PARTY_LOADS[0]
    )
    change = versions.apply_versions(
        loaded.current, parties.one_per_name(second, suppliers), "name", _PARTY_LOADS[1]
    )
    return change.current.unionByName(change.closed).select(
        "name", "type", "is_current", "id",
        F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("valid_from"),
    )


@query("SELECT slug, id FROM post_rows_versions", POST_VERSIONS)
def surrogate_keys(g: Given) -> DataFrame:
    """Version ids are digests of key and start, the same on every run."""
    built = post_versions(g)
    again = version_key(F.col("slug"), F.col("valid_from"))
    return built.where(F.col("id") == again).select("slug", "id")


# -- upserts ----------------------------------------------------------------

_MONTHLY = f"""
    SELECT l_partkey AS model_id, CAST(floor(l_extendedprice) AS BIGINT) AS downloads,
      CAST(l_quantity AS BIGINT) AS likes,
      CAST(strftime(l_shipdate + to_days({SHIFT_DAYS}), '%Y%m01') AS INTEGER) AS date_id,
      CAST(l_linenumber % 3 AS INTEGER) AS time_id, l_linestatus, l_orderkey * 10 + l_linenumber AS position
    FROM lineitem"""


@query(f"""
    SELECT model_id, date_id, time_id, downloads, likes FROM ({_MONTHLY})
    QUALIFY row_number() OVER (PARTITION BY model_id, date_id, time_id
      ORDER BY l_linestatus DESC, position DESC, downloads DESC, likes DESC) = 1""")
def upsert_model_metrics(g: Given) -> DataFrame:
    """Rows of one status as the table, of the other as the load; one row per model and hour."""
    rows = g.table("lineitem").selectExpr(
        "l_partkey AS model_id", "cast(floor(l_extendedprice) AS bigint) AS downloads",
        "cast(l_quantity AS bigint) AS likes",
        f"""cast(date_format(l_shipdate + make_dt_interval({SHIFT_DAYS}), 'yyyyMM') AS int) * 100 + 1
            AS date_id""",
        "l_linenumber % 3 AS time_id", "l_linestatus", "l_orderkey * 10 + l_linenumber AS position",
    )
    key, order = ["model_id", "date_id", "time_id"], ["position", "downloads", "likes"]
    older = latest.latest_by_key(rows.where("l_linestatus = 'F'"), key, order)
    upserted = latest.upsert_latest(older, rows.where("l_linestatus = 'O'"), key, order)
    return upserted.select(*key, "downloads", "likes")


@query(f"""
    SELECT slug, {stamp_sql("date_trunc('hour', loaded_at)")} AS hour, num_comments, position
    FROM ods_posts
    QUALIFY row_number() OVER (PARTITION BY slug, date_trunc('hour', loaded_at)
      ORDER BY position DESC) = 1""")
def upsert_post_metrics(g: Given) -> DataFrame:
    rows = g.posts.select(
        "slug", F.date_trunc("HOUR", "loaded_at").alias("hour"), "num_comments", "position"
    )
    cut = F.lit(POST_CUT)
    older = latest.latest_by_key(rows.where(F.col("hour") < cut), ["slug", "hour"], ["position"])
    upserted = latest.upsert_latest(
        older, rows.where(F.col("hour") >= cut), ["slug", "hour"], ["position"]
    )
    return upserted.select("slug", stamp("hour").alias("hour"), "num_comments", "position")


# -- one load through a whole flow -------------------------------------------


def post_load(g: Given) -> flows.Load:
    """The whole post feed as one load onto an empty detail layer."""
    return flows.posts_load(
        g.posts, no_rows(g, "dds.parties"), no_rows(g, "dds.dim_posts"),
        flows.StaticDimensions.generate(g.spark), POST_LOAD, ["loaded_at", "position"],
    )


def model_load(g: Given) -> flows.Load:
    return flows.models_load(
        g.model_heads, no_rows(g, "dds.parties"), no_rows(g, "dds.dim_models"), g.known_users,
        flows.StaticDimensions.generate(g.spark), MODEL_LOAD, MODEL_ORDER, whole=g.whole_models,
    )


def paper_load(g: Given, part: DataFrame, live: DataFrame, moment: dt.datetime) -> flows.Load:
    static = flows.StaticDimensions.generate(g.spark)
    return flows.papers_load(part, live, static, moment, ["position"])


def paper_loads(g: Given) -> tuple[flows.Load, flows.Load]:
    """The two loads of the paper feed, one after the other."""
    parts = [g.papers.where(F.col("loaded_at") == F.lit(m)) for m in PAPER_LOADS]
    first = paper_load(g, parts[0], no_rows(g, "dds.parties"), PAPER_LOADS[0])
    live = g.stored(first.versions["dds.parties"].current, "live-parties")
    return first, paper_load(g, parts[1], live, PAPER_LOADS[1])


_LAST_POSTS = {
    "last_posts": f"""
        SELECT * REPLACE (nullif(trim(author), '') AS author),
          md5(slug || '|{_text(POST_LOAD)}.000000') AS post_id FROM ods_posts
        QUALIFY row_number() OVER (PARTITION BY slug ORDER BY loaded_at DESC, position DESC) = 1""",
    "kept_posts": """
        SELECT * FROM last_posts
        WHERE author IS NOT NULL AND published_at >= TIMESTAMP '2000-01-01'""",
}


@query(
    """
    SELECT post_id, coalesce(total_unique_impressions, 0)::BIGINT AS total_unique_impressions,
      num_comments::BIGINT AS num_comments, (4 + position % 3)::BIGINT AS num_reactions,
      20240131 AS date_id, 0 AS time_id FROM kept_posts""",
    _LAST_POSTS,
)
def load_post_metrics(g: Given) -> DataFrame:
    return post_load(g).facts["dds.fact_posts_metrics"]


@query(
    f"""
    SELECT DISTINCT post_id, md5(reaction) AS reaction_id,
      md5(trim(u) || '|{_text(POST_LOAD)}.000000') AS user_id, 20240131 AS date_id, 0 AS time_id
    FROM (SELECT post_id, r.reaction AS reaction, unnest(r.users) AS u
          FROM (SELECT post_id, unnest(reactions) AS r FROM kept_posts))
    WHERE trim(u) <> '' AND reaction <> '??'""",
    _LAST_POSTS,
)
def insert_ignore_reactions(g: Given) -> DataFrame:
    """Reactions of one load, sent onto a table that has a part of them already."""
    rows = g.stored(post_load(g).rows["dds.fact_posts_reactions"], "reactions")
    key = ["post_id", "reaction_id", "user_id", "date_id", "time_id"]
    there = rows.where("reaction_id < '8'")
    return there.unionByName(dimensions.insert_ignore(there, rows, key))


_LAST_MODELS = {
    "last_models": f"""
        SELECT * FROM ods_models
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, {MODEL_ORDER_SQL}) = 1""",
    "kept_models": f"""
        SELECT *, md5(id || '|{_text(MODEL_LOAD)}.000000') AS model_id FROM last_models
        WHERE owner IS NOT NULL AND created_at >= TIMESTAMP '2000-01-01'""",
}


@query(
    f"""
    SELECT model_id, downloads, likes::BIGINT AS likes, trending_score,
      CAST(strftime(loaded_at, '%Y%m%d') AS INTEGER) AS date_id,
      CAST(hour(loaded_at) AS INTEGER) AS time_id FROM kept_models""",
    _LAST_MODELS,
)
def load_model_metrics(g: Given) -> DataFrame:
    return model_load(g).facts["dds.fact_models_metrics"]


@query(
    """
    SELECT CASE WHEN owner IS NULL THEN 'no_owner' ELSE 'no_created_date' END AS reason,
      id AS key, 'models' AS entity
    FROM last_models WHERE owner IS NULL OR created_at < TIMESTAMP '2000-01-01'""",
    _LAST_MODELS,
)
def load_model_rejects(g: Given) -> DataFrame:
    return model_load(g).rejects


def _model_bridge_sql(array: str, dictionary: str | None = None) -> str:
    known = f"WHERE e IN ({dictionary})" if dictionary else ""
    return f"""
        SELECT DISTINCT model_id, e AS element FROM (
          SELECT model_id, unnest({array}) AS e FROM kept_models) {known}"""


@query(
    f"SELECT model_id, md5(element) AS language_id FROM ({_model_bridge_sql('language')})",
    _LAST_MODELS,
)
def bridge_models_languages(g: Given) -> DataFrame:
    return model_load(g).rows["dds.bridge_models_languages"]


@query(
    f"SELECT model_id, md5(element) AS dataset_id FROM ({_model_bridge_sql('dataset')})",
    _LAST_MODELS,
)
def bridge_models_datasets(g: Given) -> DataFrame:
    return model_load(g).rows["dds.bridge_models_datasets"]


@query(
    f"SELECT model_id, element AS library FROM ({_model_bridge_sql('library')})", _LAST_MODELS,
)
def bridge_models_libraries(g: Given) -> DataFrame:
    """Pairs of model and library, shown by the library's tag."""
    return _by_tag(
        model_load(g).rows["dds.bridge_models_libraries"], "library",
        dimensions.dim_libraries(g.spark),
    )


@query(f"SELECT model_id, element AS task FROM ({_model_bridge_sql('task')})", _LAST_MODELS)
def bridge_models_tasks(g: Given) -> DataFrame:
    return _by_tag(
        model_load(g).rows["dds.bridge_models_tasks"], "task", dimensions.dim_tasks(g.spark)
    )


def _by_tag(bridge: DataFrame, out: str, dimension: DataFrame) -> DataFrame:
    tags = dimension.selectExpr(f"id AS {out}_id", f"replace(lower(name), ' ', '-') AS {out}")
    return bridge.join(F.broadcast(tags), f"{out}_id").select("model_id", out)


@query("""
    SELECT DISTINCT md5(id) AS paper_id, md5(a) AS author_id FROM (
      SELECT id, unnest(authors) AS a FROM ods_papers WHERE submitted_at IS NOT NULL)""")
def bridge_papers_authors(g: Given) -> DataFrame:
    """Two loads: authors of papers already known are added too."""
    return _merged_bridge(g, "dds.bridge_papers_authors", ["paper_id", "author_id"])


@query("""
    SELECT DISTINCT md5(id) AS paper_id, md5(k) AS keyword_id FROM (
      SELECT id, unnest(ai_keywords) AS k FROM ods_papers WHERE submitted_at IS NOT NULL)""")
def bridge_papers_keywords(g: Given) -> DataFrame:
    return _merged_bridge(g, "dds.bridge_papers_keywords", ["paper_id", "keyword_id"])


def _merged_bridge(g: Given, name: str, key: list[str]) -> DataFrame:
    first, second = (load.rows[name] for load in paper_loads(g))
    return first.unionByName(dimensions.new_rows(first, second, key))


@query("""
    SELECT id AS source_id, coalesce(title, '') AS title, upvotes, comments,
      CAST(CASE WHEN year(published_at) >= 2000 THEN strftime(published_at, '%Y%m%d') END AS VARCHAR)
        AS publish_date_id,
      CAST(strftime(submitted_at, '%Y%m%d') AS INTEGER) AS submitted_date_id
    FROM ods_papers WHERE submitted_at IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1""")
def insert_ignore_papers(g: Given) -> DataFrame:
    """Papers of the second load are added only where the first has none."""
    first, second = (load.rows["dds.dim_papers"] for load in paper_loads(g))
    merged = first.unionByName(dimensions.insert_ignore(first, second, ["source_id"]))
    return merged.select(
        "source_id", "title", "upvotes", "comments",
        F.col("publish_date_id").cast("string").alias("publish_date_id"), "submitted_date_id",
    )


def _merged_names(base: DataFrame, names: DataFrame) -> DataFrame:
    return dimensions.merged_names(dimensions.with_name_key(base.distinct()), names)


@query("""
    SELECT DISTINCT a AS name, md5(a) AS id FROM (
      SELECT unnest(authors) AS a FROM ods_papers
      UNION ALL SELECT 'author' || s_suppkey FROM supplier)""")
def insert_ignore_authors(g: Given) -> DataFrame:
    base = g.table("supplier").select(F.concat(F.lit("author"), F.col("s_suppkey")).alias("name"))
    return _merged_names(base, g.papers.select(F.explode("authors").alias("name")))


@query("""
    SELECT DISTINCT k AS name, md5(k) AS id FROM (
      SELECT unnest(ai_keywords) AS k FROM ods_papers
      UNION ALL SELECT lang FROM documents)""")
def insert_ignore_keywords(g: Given) -> DataFrame:
    base = g.table("documents").select(F.col("lang").alias("name"))
    return _merged_names(base, g.papers.select(F.explode("ai_keywords").alias("name")))


@query("""
    SELECT DISTINCT d AS name, md5(d) AS id FROM (
      SELECT unnest(dataset) AS d FROM ods_models
      UNION ALL SELECT 'ds' || p_size FROM part)""")
def insert_ignore_datasets(g: Given) -> DataFrame:
    base = g.table("part").select(F.concat(F.lit("ds"), F.col("p_size")).alias("name"))
    return _merged_names(base, g.models.select(F.explode("dataset").alias("name")))


@query(f"""
    SELECT 'dim_reactions' AS table_name, md5(r.reaction) AS id
    FROM (SELECT unnest(reactions) AS r FROM ods_posts) GROUP BY ALL
    UNION SELECT 'dim_date', strftime(CAST(o_orderdate AS DATE) + {SHIFT_DAYS}, '%Y%m%d') FROM orders
    UNION SELECT 'dim_date', strftime(d, '%Y%m%d')
      FROM range(TIMESTAMP '2000-01-01', TIMESTAMP '2031-01-01', INTERVAL 1 DAY) t(d)""")
def insert_ignore_static(g: Given) -> DataFrame:
    """Static dimensions onto tables that have all reactions ever seen, and the days with orders."""
    reactions = dimensions.with_name_key(
        g.posts.select(F.explode("reactions.reaction").alias("reaction")).distinct(), "reaction"
    )
    days = g.table("orders").select(
        date_id(F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS)).alias("id")
    ).distinct()
    filled = {
        "dim_reactions": reactions.unionByName(
            dimensions.insert_ignore(reactions, dimensions.dim_reactions(g.spark), ["reaction"])
        ),
        "dim_date": days.unionByName(dimensions.insert_ignore(days, g.dates.select("id"), ["id"])),
    }
    shown = [
        rows.select(F.lit(name).alias("table_name"), F.col("id").cast("string").alias("id"))
        for name, rows in filled.items()
    ]
    return shown[0].unionByName(shown[1])
