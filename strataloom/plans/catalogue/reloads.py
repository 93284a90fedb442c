"""Two loads of models or posts through a fresh warehouse, and what is stored after the second."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...operators import marts, quality
from ...schemas import TABLES, table
from ...session import fresh_dir
from ...sources.days import FACTS, DayStore
from ...sources.tables import Warehouse
from .. import flows
from ..given import MODEL_CUT, MODEL_LOAD, MODEL_ORDER, POST_CUT, POST_LOAD, Given
from ..registry import query
from .version_sql import MODEL_ORDER_SQL, MODEL_ROWS, POST_ROWS

# What came before the cut is the first load, all the rest the second.
_FIRST, _SECOND = (m.strftime("%Y-%m-%d %H:%M:%S.%f") for m in (MODEL_CUT, MODEL_LOAD))
_SENT = {
    **MODEL_ROWS,
    "sent": f"""
        SELECT *, loaded_at >= TIMESTAMP '{_FIRST}' AS again FROM model_rows
        QUALIFY row_number() OVER (PARTITION BY name, loaded_at >= TIMESTAMP '{_FIRST}'
          ORDER BY loaded_at DESC, {MODEL_ORDER_SQL}) = 1""",
    "keyed": f"""
        SELECT s.*, md5(s.name || CASE WHEN s.again AND f.hashdiff IS DISTINCT FROM s.hashdiff
          THEN '|{_SECOND}' ELSE '|{_FIRST}' END) AS model_id
        FROM sent s LEFT JOIN sent f ON f.name = s.name AND NOT f.again""",
}
_BUILT = (
    "dds.parties", "dds.dim_models", "dds.dim_datasets", "dds.fact_models_metrics",
    "dds.bridge_models_languages", "dds.bridge_models_libraries", "dds.bridge_models_tasks",
    "dds.bridge_models_datasets",
)


def fresh_warehouse(g: Given) -> tuple[Warehouse, flows.StaticDimensions]:
    """A warehouse of its own with the static dimensions; the caller drops it."""
    home = Warehouse(g.spark, fresh_dir(g.spark, "warehouse"), f"trial_{uuid.uuid4().hex[:8]}_")
    home.init_tables(["dds"])
    static = flows.StaticDimensions.generate(g.spark)
    flows.store_static(home, static)
    return home, static


def twice_loaded(g: Given, after_load: Callable[[Warehouse], object] = lambda home: None) -> Warehouse:
    """A warehouse with both loads of models; ``after_load`` runs after each of them."""
    home, static = fresh_warehouse(g)
    before = F.col("loaded_at") < F.lit(MODEL_CUT)
    for part, moment in ((before, MODEL_CUT), (~before, MODEL_LOAD)):
        load = flows.models_load(
            g.model_heads.where(part), home.live("dds.parties"), home.live("dds.dim_models"),
            g.known_users, static, moment, MODEL_ORDER, whole=g.whole_models,
        )
        flows.commit(home, load)
        after_load(home)
    return home


def _rules_sql(name: str) -> str:
    """Every rule of a table; a sound load breaks none."""
    spec = table(name)
    rules = [("not_null", c) for c in spec.required] + [("length", c) for c in spec.max_length]
    rules += [("key", ",".join(spec.key))] + [("unique", c) for c in spec.unique]
    rules += [("reference", c) for c in spec.refs]
    return " ".join(f"UNION ALL SELECT '{name}', '{rule}', '{column} 0'" for rule, column in rules)


def _audits(home: Warehouse, names: tuple[str, ...]) -> list[DataFrame]:
    """Every rule of the named tables with its violations."""
    targets = {n: home.frame(n) for n in TABLES if n.startswith("dds.")}
    return [
        quality.audit(home.frame(n), table(n), targets).select(
            F.col("table_name").alias("content"), F.col("rule").alias("key"),
            F.concat_ws(" ", "column_name", "violations").alias("detail"),
        )
        for n in names
    ]


@query(
    f"""
    SELECT 'facts' AS content, model_id AS key, concat_ws(' ', downloads, likes,
      strftime(loaded_at, '%Y%m%d'), hour(loaded_at)) AS detail FROM keyed
    UNION ALL SELECT DISTINCT 'languages', model_id, md5(element)
    FROM (SELECT model_id, unnest(language) AS element FROM keyed)
    UNION ALL SELECT DISTINCT 'datasets', model_id, md5(element)
    FROM (SELECT model_id, unnest(dataset) AS element FROM keyed)
    {' '.join(map(_rules_sql, _BUILT))}""",
    _SENT,
)
def reload_models(g: Given) -> DataFrame:
    """Facts and bridges after the second load, and the rules of all tables it has built.

    An unchanged model keeps the version of the first load.  All is one query, as the
    loads are its cost.
    """
    home = twice_loaded(g)
    facts = home.frame("dds.fact_models_metrics").select(
        F.lit("facts").alias("content"), F.col("model_id").alias("key"),
        F.concat_ws(" ", "downloads", "likes", "date_id", "time_id").alias("detail"),
    )
    bridges = [
        home.frame(f"dds.bridge_models_{name}s").select(
            F.lit(f"{name}s").alias("content"), F.col("model_id").alias("key"),
            F.col(f"{name}_id").alias("detail"),
        )
        for name in ("language", "dataset")
    ]
    shown = [facts, *bridges, *_audits(home, _BUILT)]
    out = g.stored(reduce(DataFrame.unionByName, shown), "twice-loaded")
    home.drop(["dds"])
    return out


# Most models are seen last in the last weeks of the feed.
LAST_DAY = dt.date(2006, 10, 25)
_SCORE = "CAST(coalesce(trending_score, 0) AS DECIMAL(28, 6))"
_WINDOW = f"CAST(loaded_at AS DATE) BETWEEN DATE '{LAST_DAY}' - %d AND DATE '{LAST_DAY}'"
_LOADED_MARTS = {
    **_SENT,
    "live": """
        SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY name ORDER BY again DESC) = 1""",
    "recent": f"""
        SELECT * FROM live WHERE model_id IN (SELECT model_id FROM keyed WHERE {_WINDOW % 7})""",
    "newest": f"""
        SELECT * FROM keyed WHERE {_WINDOW % 30}
        QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY loaded_at DESC) = 1""",
    "leaders": """
        SELECT live.name, n.downloads, n.likes FROM newest n JOIN live USING (model_id)
        WHERE n.downloads > 0 ORDER BY n.downloads DESC, live.name LIMIT 20""",
}


@query(
    f"""
    SELECT 'unique' AS content, model_id AS key, '' AS detail FROM recent
    UNION ALL SELECT 'tags', coalesce(pipeline_tag, 'no_tag'), CAST(count(*) AS VARCHAR) FROM recent GROUP BY 2
    UNION ALL SELECT 'licenses', coalesce(license, 'no_license'), CAST(count(*) AS VARCHAR) FROM recent GROUP BY 2
    UNION ALL SELECT 'modifications', coalesce(nullif(trim(upper(modification)), ''), 'ORIGINAL'),
      CAST(count(*) AS VARCHAR) FROM recent GROUP BY 2
    UNION ALL SELECT 'owners', r.owner, concat_ws(' ', count(DISTINCT r.model_id),
      CAST(CAST(sum({_SCORE.replace("trending", "k.trending")}) / count(*) AS DECIMAL(38, 10)) AS DECIMAL(24, 3)),
      CAST(sum(k.downloads) AS BIGINT))
    FROM recent r JOIN keyed k USING (model_id) GROUP BY 2
    UNION ALL SELECT 'days', strftime(loaded_at, '%Y-%m-%d'), concat_ws(' ',
      CAST(CAST(sum({_SCORE}) / count(*) AS DECIMAL(38, 10)) AS DECIMAL(24, 3)),
      CAST(percentile_cont(0.5) WITHIN GROUP (ORDER BY coalesce(trending_score, 0)) AS DECIMAL(24, 3)), count(*))
    FROM keyed WHERE {_WINDOW % 30} GROUP BY 2
    UNION ALL SELECT 'leaders', name, concat_ws(' ', rank() OVER (ORDER BY downloads DESC), downloads, likes)
    FROM leaders""",
    _LOADED_MARTS,
)
def reload_marts(g: Given) -> DataFrame:
    """The seven marts over the tables that two loads of models have built.

    After each load the day partials of the days in its ledger note are computed anew, and
    the marts merge them with the dimensions as stored.
    """
    store = DayStore(g.spark, fresh_dir(g.spark, "days"))
    home = twice_loaded(g, store.update)
    t = marts.DetailTables(
        home.frame("dds.dim_models"), home.frame("dds.parties"), home.frame(FACTS),
        home.frame("dds.dim_date"), store.read(),
    )
    unique = g.stored(marts.unique_recent(t, LAST_DAY), "unique")
    shown = [
        ("unique", unique, "model_id", (F.lit(""),)),
        ("tags", marts.tag_pie(t, unique), "pipeline_tag", ("models_count",)),
        ("licenses", marts.license_histogram(t, unique), "license", ("models_count",)),
        ("modifications", marts.modification_pie(t, unique), "modification_type", ("models_count",)),
        ("owners", marts.owners_treemap(t, unique), "owner_name",
         ("models_count", "avg_trending_score", "total_downloads")),
        ("days", marts.trending_line(t, LAST_DAY), F.date_format("trend_date", "yyyy-MM-dd"),
         ("avg_trending_score", "median_trending_score", "models_count")),
        ("leaders", marts.leaderboard(t, LAST_DAY), "model_name",
         ("rank_downloads", "latest_downloads_30d", "latest_likes_30d")),
    ]
    rows = [
        mart.select(
            F.lit(content).alias("content"), (F.col(key) if isinstance(key, str) else key).alias("key"),
            F.concat_ws(" ", *detail).alias("detail"),
        )
        for content, mart, key, detail in shown
    ]
    out = g.stored(reduce(DataFrame.unionByName, rows), "loaded-marts")
    home.drop(["dds"])
    return out


_POST_FIRST, _POST_SECOND = (m.strftime("%Y-%m-%d %H:%M:%S.%f") for m in (POST_CUT, POST_LOAD))
_POST_DAYS = ", ".join(m.strftime("%Y%m%d") for m in (POST_LOAD, POST_CUT))
_POSTS_SENT = {
    **POST_ROWS,
    "sent": f"""
        SELECT *, loaded_at >= TIMESTAMP '{_POST_FIRST}' AS again FROM post_rows
        QUALIFY row_number() OVER (PARTITION BY slug, loaded_at >= TIMESTAMP '{_POST_FIRST}'
          ORDER BY loaded_at DESC, position DESC) = 1""",
    "keyed": f"""
        SELECT s.*, md5(s.slug || CASE WHEN s.again AND f.hashdiff IS DISTINCT FROM s.hashdiff
            THEN '|{_POST_SECOND}' ELSE '|{_POST_FIRST}' END) AS post_id,
          if(s.again, {_POST_DAYS}) AS date_id
        FROM sent s LEFT JOIN sent f ON f.slug = s.slug AND NOT f.again
        WHERE s.author IS NOT NULL AND s.published_at >= TIMESTAMP '2000-01-01'""",
    "reacted": """
        SELECT slug, again, r.reaction AS reaction, trim(unnest(r.users)) AS name
        FROM (SELECT slug, again, unnest(reactions) AS r FROM sent)""",
    "early": """
        SELECT author AS name FROM sent WHERE NOT again AND author IS NOT NULL
        UNION SELECT name FROM reacted WHERE NOT again AND name <> ''""",
}
_BUILT_FROM_POSTS = ("dds.parties", "dds.dim_posts", "dds.fact_posts_metrics", "dds.fact_posts_reactions")


@query(
    f"""
    SELECT 'facts' AS content, post_id AS key, concat_ws(' ', coalesce(total_unique_impressions, 0),
      coalesce(num_comments, 0), 4 + position % 3, date_id, 0) AS detail FROM keyed
    UNION ALL SELECT DISTINCT 'reactions', post_id, concat_ws(' ', md5(reaction),
      md5(name || if(r.again AND name NOT IN (FROM early), '|{_POST_SECOND}', '|{_POST_FIRST}')), date_id, 0)
    FROM keyed k JOIN reacted r ON r.slug = k.slug AND r.again = k.again WHERE name <> '' AND reaction <> '??'
    UNION ALL SELECT 'rejects', slug, if(again, 2, 1) || if(author IS NULL, ' no_author', ' no_publish_date')
    FROM sent WHERE author IS NULL OR published_at < TIMESTAMP '2000-01-01'
    {' '.join(map(_rules_sql, _BUILT_FROM_POSTS))}""",
    _POSTS_SENT,
)
def reload_posts(g: Given) -> DataFrame:
    """Facts and reactions after a second load of posts, what either load has rejected, and
    the rules of all tables the loads have built.

    An unchanged post and a known user keep the version of the first load.
    """
    home, static = fresh_warehouse(g)
    shown = []
    before = F.col("loaded_at") < F.lit(POST_CUT)
    for number, (part, moment) in enumerate(((before, POST_CUT), (~before, POST_LOAD)), 1):
        load = flows.posts_load(
            g.posts.where(part), home.live("dds.parties"), home.live("dds.dim_posts"), static,
            moment, ["loaded_at", "position"],
        )
        flows.commit(home, load)
        shown.append(load.rejects.select(
            F.lit("rejects").alias("content"), "key", F.concat_ws(" ", F.lit(number), "reason").alias("detail")
        ))
    shown += [
        home.frame(f"dds.fact_posts_{name}").select(
            F.lit(content).alias("content"), F.col("post_id").alias("key"),
            F.concat_ws(" ", *columns, "date_id", "time_id").alias("detail"),
        )
        for content, name, columns in (
            ("facts", "metrics", ("total_unique_impressions", "num_comments", "num_reactions")),
            ("reactions", "reactions", ("reaction_id", "user_id")),
        )
    ]
    out = g.stored(reduce(DataFrame.unionByName, [*shown, *_audits(home, _BUILT_FROM_POSTS)]), "twice-loaded")
    home.drop(["dds"])
    return out
