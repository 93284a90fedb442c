"""The catalogue of named queries, each with its SQL counterpart where it has one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .given import Given, with_feeds


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Given], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Given(spark, sf_dir))


CATALOGUE: dict[str, Query] = {}


def query(sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a function of the given tables under its own name."""

    def register(build: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
        name = build.__name__
        if name in CATALOGUE:
            raise ValueError(f"{name} is registered twice")
        text = with_feeds(sql, extra) if sql else None
        CATALOGUE[name] = Query(name, build, text)
        return build

    return register


# -- plain forms of values for the side-by-side check -----------------------


def stamp(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def stamp_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def listed(column: str | Column) -> Column:
    return F.array_join(column, ",")


def as_double(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")
