"""Aggregates, windows, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.numbers import exact, round_half_up
from ...functions.text import modification_label
from ...operators import flatten, latest, parties, quality, ranking, sketches
from ...sources import feed
from ..given import Given
from ..registry import as_double, query, stamp, stamp_sql
from .joins import own_joined_stats

# -- aggregates -------------------------------------------------------------


@query("""
    SELECT l_returnflag, count(DISTINCT l_partkey) AS models FROM lineitem GROUP BY 1""")
def agg_count_distinct(g: Given) -> DataFrame:
    return g.table("lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("models")
    )


@query("""
    SELECT l_suppkey, CAST(CAST(round(CAST(sum(CAST(l_discount AS DECIMAL(28, 6))) / count(*)
      AS DECIMAL(38, 10)), 3) AS DECIMAL(24, 3)) AS DOUBLE) AS mean FROM lineitem GROUP BY 1""")
def agg_avg_round(g: Given) -> DataFrame:
    mean = F.sum(exact(F.col("l_discount"))) / F.count(F.lit(1))
    return g.table("lineitem").groupBy("l_suppkey").agg(
        as_double(round_half_up(mean, 3)).alias("mean")
    )


@query("""
    SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(28, 6))) AS DOUBLE) AS total
    FROM lineitem GROUP BY 1""")
def agg_sum(g: Given) -> DataFrame:
    return g.table("lineitem").groupBy("l_suppkey").agg(
        as_double(F.sum(exact(F.col("l_extendedprice")))).alias("total")
    )


@query("""
    SELECT event_type, percentile_cont(0.5) WITHIN GROUP (ORDER BY value) AS median
    FROM events GROUP BY 1""")
def agg_median(g: Given) -> DataFrame:
    return ranking.percentile_by(g.table("events"), ["event_type"], "value", 0.5, "median")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_count_star(g: Given) -> DataFrame:
    return g.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("SELECT avg(CAST(l_quantity AS BIGINT)) AS avg_likes FROM lineitem")
def agg_global_avg(g: Given) -> DataFrame:
    return g.table("lineitem").agg(F.avg(F.col("l_quantity").cast("long")).alias("avg_likes"))


@query("""
    SELECT coalesce(nullif(trim(upper(modification)), ''), 'ORIGINAL') AS label, owner_id,
      count(*) AS n FROM dds_models GROUP BY 1, 2""")
def group_by_expr(g: Given) -> DataFrame:
    label = modification_label(F.col("modification")).alias("label")
    return g.detail.models.groupBy(label, "owner_id").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT 'owner' AS kind, owner AS value FROM ods_models WHERE owner IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'date', strftime(loaded_at, '%Y-%m-%d') FROM ods_models GROUP BY 2
    UNION ALL SELECT 'dataset', d FROM (SELECT unnest(dataset) AS d FROM ods_models) GROUP BY 2
    UNION ALL SELECT 'author', a FROM (SELECT unnest(authors) AS a FROM ods_papers) GROUP BY 2""")
def agg_distinct_sets(g: Given) -> DataFrame:
    """Distinct owners, days, datasets and authors of the loads."""
    models = g.models

    def labelled(kind: str, values: DataFrame) -> DataFrame:
        return values.select(F.lit(kind).alias("kind"), F.col(values.columns[0]).alias("value"))

    owners = models.select("owner").where("owner IS NOT NULL").distinct()
    days = models.select(F.date_format("loaded_at", "yyyy-MM-dd")).distinct()
    return (
        labelled("owner", owners)
        .unionByName(labelled("date", days))
        .unionByName(labelled("dataset", flatten.distinct_elements(models, "dataset")))
        .unionByName(labelled("author", flatten.distinct_elements(g.papers, "authors")))
    )


@query("SELECT position, CAST(2 + position % 3 + 2 AS BIGINT) AS num_reactions FROM ods_posts")
def agg_reaction_total(g: Given) -> DataFrame:
    return g.posts.select(
        "position", flatten.reaction_total(F.col("reactions")).alias("num_reactions")
    )


@query("""
    SELECT count(*) AS total_count, count(DISTINCT name) AS unique_count FROM (
      SELECT submitted_by AS name FROM ods_papers
      UNION ALL SELECT organization FROM ods_papers WHERE organization IS NOT NULL)""")
def agg_total_vs_unique(g: Given) -> DataFrame:
    names = g.papers.select(F.col("submitted_by").alias("name")).unionByName(
        g.papers.where("organization IS NOT NULL").select(F.col("organization").alias("name"))
    )
    return quality.total_and_unique(names, "name")


@query(f"""
    SELECT o_custkey, o_orderkey, o_totalprice, {stamp_sql('o_orderdate')} AS o_orderdate
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_by_key(g: Given) -> DataFrame:
    last = latest.latest_by_key(g.table("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return last.select(
        "o_custkey", "o_orderkey", "o_totalprice", stamp("o_orderdate").alias("o_orderdate")
    )


# -- windows and top-k ------------------------------------------------------


@query("""
    SELECT o_orderkey, o_totalprice, CAST(place AS INTEGER) AS place FROM (
      SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS place FROM orders)
    ORDER BY place, o_orderkey LIMIT 20""")
def rank_downloads(g: Given) -> DataFrame:
    ranked = ranking.ranked_top_k(g.table("orders"), 20, "o_totalprice", ["o_orderkey"], "place")
    return ranked.select("o_orderkey", "o_totalprice", "place")


@query("""
    SELECT DISTINCT ON (model_id) model_id, downloads, likes, date_id, time_id FROM dds_metrics
    ORDER BY model_id, date_id DESC, time_id DESC, downloads DESC, likes DESC""")
def distinct_on_latest(g: Given) -> DataFrame:
    metrics = g.detail.metrics.select("model_id", "downloads", "likes", "date_id", "time_id")
    return latest.latest_by_key(metrics, ["model_id"], ["date_id", "time_id", "downloads", "likes"])


@query("""
    SELECT l_orderkey AS id, l_linenumber, l_extendedprice AS downloads FROM lineitem
    ORDER BY downloads DESC, id, l_linenumber LIMIT 10""")
def top10_downloads(g: Given) -> DataFrame:
    rows = g.table("lineitem").select(
        F.col("l_orderkey").alias("id"), "l_linenumber",
        F.col("l_extendedprice").alias("downloads"),
    )
    return ranking.top_k(rows, 10, "downloads", ["id", "l_linenumber"])


@query("""
    SELECT p_type AS label, count(*) AS cnt FROM part GROUP BY 1 ORDER BY cnt DESC, label LIMIT 10""")
def top_groups(g: Given) -> DataFrame:
    return ranking.top_groups(g.table("part").withColumnRenamed("p_type", "label"), "label", 10)


@query("""
    SELECT o_custkey, n, CAST(place AS INTEGER) AS place FROM (
      SELECT o_custkey, n, rank() OVER (ORDER BY n DESC) AS place
      FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1))
    ORDER BY place, o_custkey LIMIT 20""")
def leaderboard_top20(g: Given) -> DataFrame:
    """Ranks with many ties: customers by number of orders."""
    counts = ranking.counts_by(g.table("orders"), "o_custkey", "n")
    return ranking.ranked_top_k(counts, 20, "n", ["o_custkey"], "place")


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY day DESC""")
def order_trend(g: Given) -> DataFrame:
    days = g.table("events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return days.agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("day").desc())


@query("""
    SELECT c_mktsegment AS dictionary, array_to_string(list_slice(list_sort(list(c_name)), 1, 10), ',')
      AS sample FROM customer GROUP BY 1""")
def sample_first10(g: Given) -> DataFrame:
    named = g.table("customer").withColumnsRenamed({"c_mktsegment": "dictionary", "c_name": "name"})
    return quality.first_values(named, "dictionary", "name", "sample")


@query("""
    SELECT id, trending_score, position FROM model_feed
    ORDER BY trending_score DESC, id, position LIMIT 50""")
def source_top_n(g: Given) -> DataFrame:
    rows = g.model_feed.select("id", "trending_score", "position")
    return feed.top_by_score(rows, tie_break=("id", "position"))


# -- set operations ---------------------------------------------------------


@query("""
    SELECT name, count(*) AS n FROM (
      SELECT owner AS name FROM ods_models
      UNION ALL SELECT submitted_by FROM ods_papers
      UNION ALL SELECT organization FROM ods_papers
      UNION ALL SELECT nullif(trim(author), '') FROM ods_posts
      UNION ALL SELECT nullif(trim(unnest(r.users)), '')
        FROM (SELECT unnest(reactions) AS r FROM ods_posts))
    WHERE name IS NOT NULL GROUP BY 1""")
def union_all_parties(g: Given) -> DataFrame:
    names = parties.all_party_names(g.models, g.papers, g.posts)
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT source, lang FROM documents")
def distinct_values(g: Given) -> DataFrame:
    return g.table("documents").select("source", "lang").distinct()


@query("""
    SELECT upper(lang) AS code FROM documents UNION SELECT upper(event_type) FROM events""")
def set_union_codes(g: Given) -> DataFrame:
    langs = g.table("documents").select(F.upper("lang").alias("code"))
    return langs.unionByName(g.table("events").select(F.upper("event_type").alias("code"))).distinct()


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference(g: Given) -> DataFrame:
    docs = g.table("documents").select("doc_id").distinct()
    return docs.join(g.table("labels").select("doc_id"), "doc_id", "left_anti")


# -- the store comparison queries -------------------------------------------


@query("SELECT avg(likes) AS avg_likes FROM model_feed")
def avg_likes(g: Given) -> DataFrame:
    return g.model_feed.agg(F.avg("likes").alias("avg_likes"))


@query("""
    SELECT modification, count(*) AS row_count FROM ods_models
    WHERE modification IS NOT NULL AND modification <> '' GROUP BY 1 ORDER BY row_count DESC, 1""")
def modification_stats(g: Given) -> DataFrame:
    present = g.models.where("modification IS NOT NULL AND modification <> ''")
    return ranking.top_groups(present, "modification", name="row_count")


@query("""
    SELECT d.modification AS modification, count(*) AS cnt FROM ods_models f
      JOIN (SELECT DISTINCT modification FROM ods_models WHERE modification <> '') d
        ON f.modification = d.modification
    GROUP BY 1 ORDER BY cnt DESC, 1 LIMIT 10""")
def join_modification_stats(g: Given) -> DataFrame:
    """Facts against the distinct dimension of a tag attribute, counted, ten greatest."""
    return own_joined_stats(g.models)


@query("""
    SELECT license, count(DISTINCT model_id) AS n, true AS near
    FROM dds_metrics JOIN dds_models ON model_id = id
    WHERE day BETWEEN DATE '2005-06-24' AND DATE '2005-06-30' GROUP BY 1""")
def agg_distinct_sketches(g: Given) -> DataFrame:
    """Models with metrics in a week per license: the exact count, and whether the merged
    daily sketches keep their stated error.

    The sketches of all days are stored; the week's estimate reads those of its days only.
    """
    t = g.detail
    labelled = t.metrics.join(t.models.select(F.col("id").alias("model_id"), "license"), "model_id")
    daily = g.stored(sketches.daily_sketches(labelled, "date_id", ["license"], "model_id"), "sketches")
    week = F.col("date_id").between(20050624, 20050630)
    merged = sketches.merged_distinct(daily.where(week), ["license"])
    exact = labelled.where(week).groupBy("license").agg(F.count_distinct("model_id").alias("n"))
    other = merged.withColumnRenamed("license", "of")
    joined = exact.join(other, F.col("license").eqNullSafe(F.col("of")))
    return joined.select("license", "n", sketches.within_bound(F.col("estimate"), F.col("n")).alias("near"))
