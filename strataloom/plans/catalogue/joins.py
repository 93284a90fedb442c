"""Joins and look-ups."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.numbers import exact
from ...operators import dimensions, lookups, marts, versions
from ...operators.flatten import explode_reactions, reaction_users, unnest
from ...operators.parties import one_per_name, paper_parties
from ...operators.quality import missing_names
from ...schemas import table
from ...session import stored
from ...sources.clustered import clustered
from .. import flows
from ..given import AS_OF, PAPER_LOADS, Given
from ..registry import as_double, query, stamp, stamp_sql
from .version_sql import POST_VERSIONS

_UTC = dt.timezone.utc


def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


@query("""
    SELECT day AS date, count(*) AS n, CAST(sum(downloads) AS BIGINT) AS downloads
    FROM dds_metrics GROUP BY 1""")
def join_fact_date(g: Given) -> DataFrame:
    """Facts with their calendar day; the calendar is small and broadcast."""
    t = g.detail
    return marts.with_day(t.metrics, t.dates).groupBy("date").agg(
        _n(), F.sum("downloads").alias("downloads")
    )


@query("""
    SELECT license, count(*) AS n, CAST(sum(likes) AS BIGINT) AS likes
    FROM dds_metrics JOIN dds_models ON model_id = id GROUP BY 1""")
def join_fact_model(g: Given) -> DataFrame:
    """Facts per model attribute: summed per model before the join."""
    return _by_license(g.detail)


def _by_license(t: marts.DetailTables) -> DataFrame:
    per_model = t.metrics.groupBy("model_id").agg(_n(), F.sum("likes").alias("likes"))
    joined = per_model.join(t.models.withColumnRenamed("id", "model_id"), "model_id")
    return joined.groupBy("license").agg(F.sum("n").alias("n"), F.sum("likes").alias("likes"))


@query("""
    SELECT license, count(*) AS n, CAST(sum(likes) AS BIGINT) AS likes
    FROM dds_metrics JOIN dds_models ON model_id = id GROUP BY 1""")
def join_fact_model_clustered(g: Given) -> DataFrame:
    """The same over tables bucketed by model: facts are grouped and joined where they lie."""
    return _by_license(clustered_detail(g.detail))


@query("SELECT model_id, name FROM unique_recent JOIN dds_models ON model_id = id")
def join_mart_model(g: Given) -> DataFrame:
    unique = marts.unique_recent(g.detail, AS_OF)
    models = g.detail.models.select(F.col("id").alias("model_id"), "name")
    return unique.join(models, "model_id")


@query("""
    SELECT m.name AS model, p.name AS owner FROM dds_models m JOIN dds_parties p ON owner_id = p.id""")
def join_owner(g: Given) -> DataFrame:
    owners = g.detail.parties.select(F.col("id").alias("owner_id"), F.col("name").alias("owner"))
    return g.detail.models.join(owners, "owner_id").select(F.col("name").alias("model"), "owner")


@query("""
    SELECT model_id, count(*) AS n, CAST(sum(downloads) AS BIGINT) AS downloads
    FROM unique_recent JOIN dds_metrics USING (model_id) GROUP BY 1""")
def join_mart_fact(g: Given) -> DataFrame:
    """Every snapshot of the week's models, summed per model."""
    unique = marts.unique_recent(g.detail, AS_OF)
    facts = g.detail.metrics.join(unique, "model_id", "left_semi")
    return facts.groupBy("model_id").agg(_n(), F.sum("downloads").alias("downloads"))


@query("""
    SELECT p.name AS owner, m.license AS license, count(*) AS n,
      CAST(sum(CAST(f.trending_score AS DECIMAL(28, 6))) AS DOUBLE) AS score
    FROM unique_recent u JOIN dds_models m ON u.model_id = m.id
      JOIN dds_parties p ON m.owner_id = p.id JOIN dds_metrics f ON u.model_id = f.model_id
    GROUP BY ALL""")
def star_join_4way(g: Given) -> DataFrame:
    return _star(g.detail)


def _star(t: marts.DetailTables) -> DataFrame:
    unique = marts.unique_recent(t, AS_OF)
    per_model = (
        t.metrics.join(unique, "model_id", "left_semi").groupBy("model_id")
        .agg(_n(), F.sum(exact(F.col("trending_score"))).alias("score"))
    )
    models = t.models.select(F.col("id").alias("model_id"), "owner_id", "license")
    owners = t.parties.select(F.col("id").alias("owner_id"), F.col("name").alias("owner"))
    star = per_model.join(models, "model_id").join(owners, "owner_id")
    return star.groupBy("owner", "license").agg(
        F.sum("n").alias("n"), as_double(F.sum("score")).alias("score")
    )


# Buckets of the given tables; a cluster's tables take as many as give buckets of some
# hundred megabytes.
_BUCKETS = 16


def clustered_detail(t: marts.DetailTables) -> marts.DetailTables:
    """Facts and models bucketed by model."""
    model = t.models.schema["id"].dataType
    metrics = t.metrics.withColumn("model_id", F.col("model_id").cast(model))
    return replace(
        t,
        metrics=clustered(metrics, "model_id", _BUCKETS, "facts_by_model"),
        models=clustered(t.models, "id", _BUCKETS, "models_by_id"),
    )


@query("""
    SELECT p.name AS owner, m.license AS license, count(*) AS n,
      CAST(sum(CAST(f.trending_score AS DECIMAL(28, 6))) AS DOUBLE) AS score
    FROM unique_recent u JOIN dds_models m ON u.model_id = m.id
      JOIN dds_parties p ON m.owner_id = p.id JOIN dds_metrics f ON u.model_id = f.model_id
    GROUP BY ALL""")
def star_join_clustered(g: Given) -> DataFrame:
    return _star(clustered_detail(g.detail))


@query("""
    SELECT CAST(CASE WHEN year(o_orderdate) >= 2000 THEN strftime(o_orderdate, '%Y%m%d') END
        AS VARCHAR) AS date_id,
      CAST(CASE WHEN year(o_orderdate) >= 2000 THEN hour(o_orderdate) END AS VARCHAR) AS time_id,
      count(*) AS n
    FROM orders GROUP BY ALL""")
def lookup_date_hour(g: Given) -> DataFrame:
    """Calendar keys; days before the calendar starts have none."""
    keyed = lookups.with_calendar(g.table("orders"), g.dates, "o_orderdate")
    return keyed.groupBy(
        F.col("date_id").cast("string").alias("date_id"),
        F.col("time_id").cast("string").alias("time_id"),
    ).agg(_n())


@query("""
    SELECT lang, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French'
        WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END AS name,
      md5(lang) AS language_id, count(*) AS n
    FROM documents WHERE lang IN ('en', 'fr', 'de', 'es') GROUP BY ALL""")
def lookup_language(g: Given) -> DataFrame:
    found = lookups.with_code_id(
        g.table("documents"), dimensions.dim_languages(g.spark), "code", "lang", "language_id"
    )
    names = dimensions.dim_languages(g.spark).select(F.col("id").alias("language_id"), "name")
    return found.join(F.broadcast(names), "language_id").groupBy("lang", "name", "language_id").agg(_n())


def _library_rows(g: Given, array: str) -> DataFrame:
    return unnest(g.models, array, "tag", ["position"])


@query("""
    SELECT tag, count(*) AS n FROM (SELECT unnest(library) AS tag FROM ods_models) GROUP BY 1""")
def lookup_library(g: Given) -> DataFrame:
    found = lookups.with_code_id(
        _library_rows(g, "library"), dimensions.dim_libraries(g.spark), "name", "tag",
        "library_id", by_slug=True,
    )
    return found.groupBy("tag").agg(_n())


@query("""
    SELECT tag, count(*) AS n FROM (SELECT unnest(task) AS tag FROM ods_models) GROUP BY 1""")
def lookup_task(g: Given) -> DataFrame:
    found = lookups.with_code_id(
        _library_rows(g, "task"), dimensions.dim_tasks(g.spark), "name", "tag", "task_id",
        by_slug=True,
    )
    return found.groupBy("tag").agg(_n())


def _name_lookup(g: Given, df: DataFrame, array: str, known: DataFrame) -> DataFrame:
    """Names are counted first, so a very common one is a single row of the join."""
    dictionary = dimensions.with_name_key(known.distinct())
    counted = unnest(df, array, "name").groupBy("name").agg(_n())
    return lookups.with_name_id(counted, dictionary, "name", "id").select("name", "id", "n")


@query("""
    SELECT name, md5(name) AS id, count(*) AS n
    FROM (SELECT unnest(dataset) AS name FROM ods_models)
    WHERE name IN (SELECT 'ds' || p_size FROM part) GROUP BY ALL""")
def lookup_dataset(g: Given) -> DataFrame:
    known = g.table("part").select(F.concat(F.lit("ds"), F.col("p_size")).alias("name"))
    return _name_lookup(g, g.models, "dataset", known)


@query("""
    SELECT name, md5(name) AS id, count(*) AS n
    FROM (SELECT unnest(authors) AS name FROM ods_papers)
    WHERE name IN (SELECT 'author' || s_suppkey FROM supplier) GROUP BY ALL""")
def lookup_author(g: Given) -> DataFrame:
    known = g.table("supplier").select(F.concat(F.lit("author"), F.col("s_suppkey")).alias("name"))
    return _name_lookup(g, g.papers, "authors", known)


@query("""
    SELECT name, md5(name) AS id, count(*) AS n
    FROM (SELECT unnest(ai_keywords) AS name FROM ods_papers)
    WHERE name IN (SELECT unnest(string_split(text, ' ')) FROM conversations) GROUP BY ALL""")
def lookup_keyword(g: Given) -> DataFrame:
    known = g.table("conversations").select(F.explode(F.split("text", " ")).alias("name"))
    return _name_lookup(g, g.papers, "ai_keywords", known)


def no_rows(g: Given, name: str) -> DataFrame:
    return g.spark.createDataFrame([], table(name).schema)


@query("""
    SELECT id, position, organization,
      CASE WHEN organization IS NOT NULL
        THEN md5(organization || '|2024-02-01 00:00:00.000000') END AS organization_id
    FROM ods_papers""")
def lookup_party(g: Given) -> DataFrame:
    """Papers with the current party version of their organisation, if any."""
    parties = versions.apply_versions(
        no_rows(g, "dds.parties"), one_per_name(paper_parties(g.papers)), "name", PAPER_LOADS[0]
    ).current
    found = lookups.with_party_id(g.papers, parties, "organization", "organization_id")
    return found.select("id", "position", "organization", "organization_id")


@query("""
    SELECT reaction, md5(reaction) AS reaction_id, count(*) AS n
    FROM (SELECT r.reaction AS reaction, unnest(r.users) AS u
          FROM (SELECT unnest(reactions) AS r FROM ods_posts))
    WHERE trim(u) <> '' AND reaction <> '??' GROUP BY ALL""")
def lookup_reaction(g: Given) -> DataFrame:
    found = lookups.with_code_id(
        explode_reactions(g.posts), dimensions.dim_reactions(g.spark), "reaction", "reaction",
        "reaction_id",
    )
    return found.groupBy("reaction", "reaction_id").agg(_n())


_JOINED_STATS = """
    SELECT d.modification, count(*) AS cnt
    FROM ods_models f JOIN (SELECT DISTINCT modification FROM ods_models
      WHERE modification IS NOT NULL AND modification <> '') d ON f.modification = d.modification
    GROUP BY 1 ORDER BY cnt DESC, 1 LIMIT 10"""


def joined_stats(rows: DataFrame, dimension: DataFrame, label: str = "modification") -> DataFrame:
    """Rows per dimension value, the ten most frequent.

    Rows are counted per value first, so the join meets one row per value.
    """
    counted = rows.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    joined = counted.join(dimension.select(label), label)
    return joined.orderBy(F.col("cnt").desc(), label).limit(10)


def own_joined_stats(rows: DataFrame, label: str = "modification") -> DataFrame:
    """``joined_stats`` with the dimension of the rows themselves.

    The rows are derived and counted once; their distinct dimension is that of the counts,
    a row per value, which the join then meets.
    """
    counted = stored(rows.groupBy(label).agg(F.count(F.lit(1)).alias("cnt")), "counted")
    dimension = dimensions.distinct_dimension(counted, label)
    joined = counted.join(dimension.select(label), label)
    return joined.orderBy(F.col("cnt").desc(), label).limit(10)


@query(_JOINED_STATS)
def join_bench_dim(g: Given) -> DataFrame:
    return own_joined_stats(g.models)


@query("""
    SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def any_inner_join(g: Given) -> DataFrame:
    """At most one match per row, although every customer is there twice."""
    customers = g.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    twice = customers.unionByName(customers.withColumn("c_name", F.concat("c_name", F.lit("~"))))
    orders = g.table("orders").select("o_orderkey", "o_custkey")
    return lookups.any_match(orders, twice, "o_custkey", ["c_name"])


@query("""
    SELECT d.modification, count(*) AS cnt FROM dds_models f
      JOIN (SELECT DISTINCT modification FROM dds_models
            WHERE modification IS NULL OR modification <> '') d USING (modification)
    GROUP BY 1 ORDER BY cnt DESC, 1 LIMIT 10""")
def lookup_unwind(g: Given) -> DataFrame:
    """The document store's look-up and unwind: an inner join on present values."""
    models = g.detail.models
    return joined_stats(models, dimensions.distinct_values(models, "modification"))


@query("""
    SELECT user_name, count(*) AS n FROM (
      SELECT unnest(r.users) AS user_name FROM (SELECT unnest(reactions) AS r FROM ods_posts))
    GROUP BY 1""")
def lateral_explode(g: Given) -> DataFrame:
    return reaction_users(g.posts).groupBy("user_name").agg(_n())


@query("""
    SELECT DISTINCT c_name AS name FROM customer
    WHERE c_name NOT IN (SELECT replace(s_name, 'Supplier', 'Customer') FROM supplier)""")
def anti_missing(g: Given) -> DataFrame:
    known = g.table("supplier").select(
        F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("name")
    )
    return missing_names(g.table("customer").select(F.col("c_name").alias("name")), known)


@query("""
    SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def semi_known(g: Given) -> DataFrame:
    return lookups.keep_known(g.table("documents").select("doc_id"), g.table("labels"), "doc_id")


def post_versions(g: Given) -> DataFrame:
    rows = flows.prepared_posts(g.posts).select(
        "slug", "content_raw", "hashdiff", "loaded_at", "position"
    )
    return versions.rebuild_versions(rows, "slug", order=["position"])


@query(
    f"""
    SELECT slug, content_raw, {stamp_sql('valid_from')} AS valid_from,
      {stamp_sql('valid_to')} AS valid_to
    FROM post_rows_versions
    WHERE valid_from <= TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-15' < valid_to""",
    POST_VERSIONS,
)
def point_in_time(g: Given) -> DataFrame:
    return versions.as_of(post_versions(g), dt.datetime(2024, 1, 15, tzinfo=_UTC)).select(
        "slug", "content_raw", stamp("valid_from").alias("valid_from"),
        stamp("valid_to").alias("valid_to"),
    )


@query(
    f"""
    SELECT e.event_id, v.slug, v.content_raw, {stamp_sql('v.valid_from')} AS valid_from
    FROM events e JOIN post_rows_versions v
      ON v.slug = 'post-' || e.user_id || '-' || e.event_type
      AND v.valid_from <= e.ts AND e.ts < v.valid_to""",
    POST_VERSIONS,
)
def point_in_time_join(g: Given) -> DataFrame:
    """Each event with the version of its post valid at that moment."""
    facts = g.table("events").selectExpr(
        "event_id", "ts", "concat('post-', user_id, '-', event_type) AS slug"
    )
    joined = versions.as_of_join(
        facts, post_versions(g), "slug", "ts", unit="day",
    )
    return joined.select("event_id", "slug", "content_raw", stamp("valid_from").alias("valid_from"))
