"""The seven marts over the given tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.moments import date_id_of, recent_date_ids
from ...operators import marts
from ...session import fresh_dir
from ...sources.days import DayStore
from ..given import AS_OF, Given
from ..registry import as_double, query

_PIE = "FROM unique_recent JOIN dds_models ON model_id = id WHERE is_current GROUP BY 1"
_MEAN = "CAST(sum(CAST(trending_score AS DECIMAL(28, 6))) / count(*) AS DECIMAL(38, 10))"


def _unique(g: Given) -> DataFrame:
    return marts.unique_recent(g.detail, AS_OF)


@query("SELECT model_id FROM unique_recent")
def mart_unique_top7d(g: Given) -> DataFrame:
    return _unique(g)


@query(f"SELECT coalesce(pipeline_tag, 'no_tag') AS pipeline_tag, count(DISTINCT model_id) AS models_count {_PIE}")
def mart_tag_pie(g: Given) -> DataFrame:
    return marts.tag_pie(g.detail, _unique(g))


_TREEMAP = f"""
    SELECT p.name AS owner_name, p.type AS owner_type, count(DISTINCT u.model_id) AS models_count,
      CAST(CAST(round({_MEAN}, 3) AS DECIMAL(24, 3)) AS DOUBLE) AS avg_trending_score,
      CAST(sum(downloads) AS BIGINT) AS total_downloads
    FROM unique_recent u JOIN dds_models m ON u.model_id = m.id
      JOIN dds_parties p ON m.owner_id = p.id JOIN %s f ON u.model_id = f.model_id
    WHERE m.is_current GROUP BY ALL"""


def _plain(df: DataFrame, *decimals: str) -> DataFrame:
    return df.withColumns({c: as_double(c) for c in decimals})


@query(_TREEMAP % "dds_metrics")
def mart_owners_treemap(g: Given) -> DataFrame:
    return _plain(marts.owners_treemap(g.detail, _unique(g)), "avg_trending_score")


@query(
    _TREEMAP % "latest",
    {"latest": """
        SELECT * FROM dds_metrics
        QUALIFY row_number() OVER (PARTITION BY model_id
          ORDER BY date_id DESC, time_id DESC, downloads DESC, likes DESC) = 1"""},
)
def mart_owners_treemap_latest(g: Given) -> DataFrame:
    """The same with the last snapshot of each version only."""
    treemap = marts.owners_treemap(g.detail, _unique(g), snapshot="latest")
    return _plain(treemap, "avg_trending_score")


@query(f"""
    SELECT strftime(day, '%Y-%m-%d') AS trend_date,
      CAST(CAST(round({_MEAN}, 3) AS DECIMAL(24, 3)) AS DOUBLE) AS avg_trending_score,
      CAST(CAST(percentile_cont(0.5) WITHIN GROUP (ORDER BY trending_score) AS DECIMAL(24, 3))
        AS DOUBLE) AS median_trending_score,
      count(*) AS models_count, count(DISTINCT model_id) AS distinct_models
    FROM dds_metrics WHERE day BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' GROUP BY 1""")
def mart_trending_line(g: Given) -> DataFrame:
    line = marts.trending_line(g.detail, AS_OF, distinct_models=True)
    return _plain(line, "avg_trending_score", "median_trending_score").withColumn(
        "trend_date", F.date_format("trend_date", "yyyy-MM-dd")
    )


@query(f"SELECT coalesce(license, 'no_license') AS license, count(DISTINCT model_id) AS models_count {_PIE}")
def mart_license_histogram(g: Given) -> DataFrame:
    return marts.license_histogram(g.detail, _unique(g))


@query(f"""
    SELECT coalesce(nullif(trim(upper(modification)), ''), 'ORIGINAL') AS modification_type,
      count(DISTINCT model_id) AS models_count {_PIE}""")
def mart_modification_pie(g: Given) -> DataFrame:
    return marts.modification_pie(g.detail, _unique(g))


_LEADERBOARD = {
    "latest": f"""
        SELECT * FROM dds_metrics WHERE day BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}'
        QUALIFY row_number() OVER (PARTITION BY model_id ORDER BY date_id DESC, time_id DESC,
          downloads DESC, likes DESC, trending_score DESC) = 1""",
}


@query(
    """
    SELECT CAST(rank() OVER (ORDER BY downloads DESC) AS INTEGER) AS rank_downloads,
      m.name AS model_name, p.name AS owner_name,
      coalesce(nullif(trim(upper(modification)), ''), 'ORIGINAL') AS modification_type,
      downloads AS latest_downloads_30d, likes AS latest_likes_30d,
      CAST(round(CAST(CAST(likes AS DOUBLE) / downloads AS DECIMAL(38, 12)), 4) AS DOUBLE) AS likes_ratio,
      CAST(CAST(trending_score AS DECIMAL(24, 3)) AS DOUBLE) AS latest_trending_score
    FROM latest JOIN dds_models m ON model_id = m.id JOIN dds_parties p ON owner_id = p.id
    WHERE is_current AND downloads > 0 ORDER BY rank_downloads, model_name LIMIT 20""",
    _LEADERBOARD,
)
def mart_leaderboard_30d(g: Given) -> DataFrame:
    board = marts.leaderboard(g.detail, AS_OF)
    return _plain(board, "likes_ratio", "latest_trending_score")


@query(
    f"""
    SELECT 'unique_top7d' AS mart, count(*) AS n FROM unique_recent
    UNION ALL SELECT 'tag_pie', count(*) FROM (SELECT coalesce(pipeline_tag, 'no_tag') {_PIE})
    UNION ALL SELECT 'license_histogram', count(*) FROM (SELECT coalesce(license, 'no_license') {_PIE})
    UNION ALL SELECT 'modification_pie', count(*) FROM (
      SELECT coalesce(nullif(trim(upper(modification)), ''), 'ORIGINAL') {_PIE})
    UNION ALL SELECT 'owners_treemap', count(*) FROM ({_TREEMAP % 'dds_metrics'})
    UNION ALL SELECT 'leaderboard_30d', least(20, count(*)) FROM latest
      JOIN dds_models m ON model_id = m.id JOIN dds_parties p ON owner_id = p.id
      WHERE is_current AND downloads > 0
    UNION ALL SELECT 'trending_line', count(DISTINCT day) FROM dds_metrics
      WHERE day BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}'""",
    _LEADERBOARD,
)
def mart_refresh_all(g: Given) -> DataFrame:
    """All marts written from one computation of the week's models."""
    root = fresh_dir(g.spark, "marts")
    written: list[str] = []

    def write(name: str, mart: DataFrame) -> None:
        mart.write.mode("overwrite").parquet(f"{root}/mart={name}")
        written.append(name)

    marts.refresh(g.detail, AS_OF, write)
    counts = [
        g.spark.read.parquet(f"{root}/mart={name}").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("mart"), "n")
        for name in written
    ]
    total = counts[0]
    for more in counts[1:]:
        total = total.unionByName(more)
    return total


@query(
    f"""
    SELECT 'line' AS mart, strftime(day, '%Y-%m-%d') AS key,
      concat_ws(' ', CAST({_MEAN} AS DECIMAL(24, 3)),
        CAST(percentile_cont(0.5) WITHIN GROUP (ORDER BY trending_score) AS DECIMAL(24, 3)),
        count(*), count(DISTINCT model_id)) AS detail
    FROM dds_metrics WHERE day BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' GROUP BY 2
    UNION ALL SELECT 'leader', m.name, concat_ws(' ', rank() OVER (ORDER BY downloads DESC), downloads, likes)
    FROM (SELECT m.name AS name, downloads, likes FROM latest JOIN dds_models m ON model_id = m.id
      JOIN dds_parties p ON owner_id = p.id
      WHERE is_current AND downloads > 0 ORDER BY downloads DESC, m.name LIMIT 20) AS m""",
    _LEADERBOARD,
)
def mart_by_day_partials(g: Given) -> DataFrame:
    """Trend and leaderboard merged from stored days, after a second load.

    The first load lacks the later half of each of the month's last ten days, which the
    second brings; only those ten days are computed anew.
    """
    store = DayStore(g.spark, fresh_dir(g.spark, "days"), "long")
    month = g.detail.metrics.where(recent_date_ids(F.col("date_id"), AS_OF, marts.TREND_DAYS))
    late = recent_date_ids(F.col("date_id"), AS_OF, 9)
    store.replace_days(month.where(~late | (F.col("time_id") <= 3)), _days(marts.TREND_DAYS))
    store.replace_days(month, _days(9))
    t = replace(g.detail, days=store.read())
    line = marts.trending_line(t, AS_OF, distinct_models=True)
    board = marts.leaderboard(t, AS_OF)
    return line.select(
        F.lit("line").alias("mart"), F.date_format("trend_date", "yyyy-MM-dd").alias("key"),
        F.concat_ws(" ", "avg_trending_score", "median_trending_score", "models_count", "distinct_models").alias("detail"),
    ).unionByName(board.select(
        F.lit("leader").alias("mart"), F.col("model_name").alias("key"),
        F.concat_ws(" ", "rank_downloads", "latest_downloads_30d", "latest_likes_30d").alias("detail"),
    ))


def _days(back: int) -> list[int]:
    return [date_id_of(AS_OF - dt.timedelta(days=d)) for d in range(back + 1)]
