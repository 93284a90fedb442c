"""Static dimensions and insert-only dictionaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import md5_key
from ..functions.moments import date_id
from ..functions.text import not_blank
from ..functions.vocabulary import LIBRARIES, REACTIONS, TASKS, languages

# The calendar's first and last day.
FIRST_DAY = dt.date(2000, 1, 1)
LAST_DAY = dt.date(2030, 12, 31)


def dim_date(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """One row per day; weeks run from Monday = 1."""
    day = F.col("date")
    weekday = F.weekday(day) + 1
    return (
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
        .select(
            date_id(day).alias("id"),
            "date",
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.dayofmonth(day).alias("day"),
            F.date_format(day, "EEEE").alias("day_name"),
            weekday.alias("week_day"),
            (weekday > 5).alias("is_weekend"),
            F.quarter(day).alias("quarter"),
            F.weekofyear(day).alias("iso_week"),
        )
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """The 24 hours; before 12 is morning, before 18 afternoon, then evening."""
    hour = F.col("id").cast("int")
    return spark.range(24).select(
        hour.alias("id"),
        F.format_string("%02d:00:00", hour).alias("time"),
        hour.alias("hour"),
        F.when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")
        .alias("time_of_day"),
        hour.between(9, 17).alias("is_business_hour"),
    )


def _constants(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    columns = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(list(rows), columns)


def dim_tasks(spark: SparkSession) -> DataFrame:
    rows = [(name, family) for family, names in TASKS.items() for name in names]
    return with_name_key(_constants(spark, rows, ["name", "type"]))


def dim_libraries(spark: SparkSession) -> DataFrame:
    return with_name_key(_constants(spark, [(n,) for n in LIBRARIES], ["name"]))


def dim_reactions(spark: SparkSession) -> DataFrame:
    return with_name_key(_constants(spark, [(r,) for r in REACTIONS], ["reaction"]), "reaction")


def dim_languages(spark: SparkSession) -> DataFrame:
    return with_name_key(_constants(spark, languages(spark), ["code", "name"]), "code")


def with_name_key(df: DataFrame, name: str = "name") -> DataFrame:
    return df.select(md5_key(F.col(name)).alias("id"), *df.columns)


def new_rows(base: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows, already one per key, whose key the table does not have yet."""
    return incoming.join(base.select(*key), list(key), "left_anti").select(*incoming.columns)


def insert_ignore(base: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the table does not have yet, one per key.

    The result is what to append; existing rows are never touched.
    """
    return new_rows(base, incoming.dropDuplicates(list(key)), key)


def new_names(base: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """Dictionary rows to append for names not known yet."""
    found = names.where(F.col(column).isNotNull()).select(F.col(column).alias("name")).distinct()
    return with_name_key(found.join(base.select("name"), "name", "left_anti"))


def merged_names(base: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """The dictionary after the new names are added."""
    return base.select("id", "name").unionByName(new_names(base, names, column))


def distinct_dimension(df: DataFrame, column: str, key: Column | None = None) -> DataFrame:
    """Distinct present values of one attribute with a digest as key."""
    value = F.col(column)
    found = df.select(column).where(not_blank(value)).distinct()
    return found.withColumn(f"{column}_id", F.md5(value) if key is None else key)


def distinct_values(df: DataFrame, column: str, drop_null: bool = False) -> DataFrame:
    """Distinct values without the empty string; NULL counts as a value by default."""
    return df.select(column).where(not_blank(F.col(column), drop_null=drop_null)).distinct()
