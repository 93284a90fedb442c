"""Generated dimensions, each read by a given table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.moments import date_id
from ...functions.vocabulary import REACTIONS, TASKS
from ...operators import dimensions
from ...operators.flatten import explode_reactions, unnest
from ...operators.lookups import with_code_id
from ..given import SHIFT_DAYS, Given
from ..registry import query

_DATE_PARTS = (
    "year", "month", "month_name", "day", "day_name", "week_day", "is_weekend", "quarter",
    "iso_week",
)


@query(f"""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id, CAST(year(d) AS INTEGER) AS year,
      CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
      CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name, CAST(isodow(d) AS INTEGER) AS week_day,
      isodow(d) >= 6 AS is_weekend, CAST(quarter(d) AS INTEGER) AS quarter,
      CAST(weekofyear(d) AS INTEGER) AS iso_week, count(o_orderkey) AS orders
    FROM (SELECT CAST(d AS DATE) AS d
          FROM range(TIMESTAMP '2000-01-01', TIMESTAMP '2031-01-01', INTERVAL 1 DAY) t(d)) c
      LEFT JOIN orders ON CAST(o_orderdate AS DATE) + {SHIFT_DAYS} = d GROUP BY d""")
def gen_dim_date(g: Given) -> DataFrame:
    """Every calendar day with all its attributes and its orders, none included."""
    orders = g.table("orders").select(
        date_id(F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS)).alias("id")
    )
    per_day = orders.groupBy("id").agg(F.count(F.lit(1)).alias("orders"))
    counted = g.dates.join(per_day, "id", "left")
    return counted.select("id", *_DATE_PARTS, F.coalesce("orders", F.lit(0)).alias("orders"))


@query("""
    SELECT h AS hour, lpad(CAST(h AS VARCHAR), 2, '0') || ':00:00' AS time,
      CASE WHEN h < 12 THEN 'morning' WHEN h < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day,
      h >= 9 AND h < 18 AS is_business_hour, count(*) AS events
    FROM (SELECT CAST(hour(ts) AS INTEGER) AS h FROM events) GROUP BY ALL""")
def gen_dim_time(g: Given) -> DataFrame:
    per_hour = g.table("events").groupBy(F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("events")
    )
    hours = F.broadcast(dimensions.dim_time(g.spark).drop("id"))
    return per_hour.join(hours, "hour")


_TASK_TYPE = " ".join(
    f"WHEN task IN ({', '.join(repr(n.lower().replace(' ', '-')) for n in names)}) THEN '{family}'"
    for family, names in TASKS.items()
)


@query(f"""
    SELECT CASE {_TASK_TYPE} END AS type, task, count(*) AS models
    FROM (SELECT unnest(task) AS task FROM ods_models) GROUP BY ALL""")
def gen_dim_tasks(g: Given) -> DataFrame:
    tasks = dimensions.dim_tasks(g.spark)
    tagged = unnest(g.models, "task", "task")
    found = with_code_id(tagged, tasks, "name", "task", "id", by_slug=True)
    types = F.broadcast(tasks.select("id", "type"))
    return found.groupBy("id", "task").agg(F.count(F.lit(1)).alias("models")).join(types, "id").drop("id")


@query("""
    SELECT library, md5(tag) AS library_id, count(*) AS models
    FROM (SELECT library[1] AS library, tags[2] AS tag FROM (
      SELECT o.library, f.tags FROM ods_models o JOIN model_feed f
        ON o.position = f.position AND o.id = f.id AND o.loaded_at = f.loaded_at
        AND o.downloads = coalesce(f.downloads, 0) AND o.likes = f.likes
        AND o.trending_score = f.trending_score))
    WHERE library IS NOT NULL GROUP BY ALL""")
def gen_dim_libraries(g: Given) -> DataFrame:
    tagged = unnest(g.models, "library", "library")
    found = with_code_id(
        tagged, dimensions.dim_libraries(g.spark), "name", "library", "library_id", by_slug=True
    )
    return found.groupBy("library", "library_id").agg(F.count(F.lit(1)).alias("models"))


_EMOJI = ", ".join(f"'{r}'" for r in REACTIONS)


@query(f"""
    SELECT reaction, md5(reaction) AS id, count(*) AS users FROM (
      SELECT r.reaction AS reaction, unnest(r.users) AS u
      FROM (SELECT unnest(reactions) AS r FROM ods_posts))
    WHERE trim(u) <> '' AND reaction IN ({_EMOJI}) GROUP BY ALL""")
def gen_dim_reactions(g: Given) -> DataFrame:
    given = explode_reactions(g.posts).groupBy("reaction").agg(F.count(F.lit(1)).alias("users"))
    return given.join(F.broadcast(dimensions.dim_reactions(g.spark)), "reaction")


@query("""
    SELECT lang AS code, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French'
      WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END AS name, count(*) AS documents
    FROM documents GROUP BY ALL""")
def gen_dim_languages(g: Given) -> DataFrame:
    per_code = g.table("documents").groupBy(F.col("lang").alias("code")).agg(
        F.count(F.lit(1)).alias("documents")
    )
    languages = F.broadcast(dimensions.dim_languages(g.spark).drop("id"))
    return per_code.join(languages, "code")
