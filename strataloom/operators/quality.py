"""Coverage of the raw layer by the dictionaries, and constraint audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import Table

SAMPLE_SIZE = 10


def mentions(raw: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    """``dictionary, name, n``: how often the raw layer mentions each name."""
    return _labelled(raw).groupBy("dictionary", "name").agg(F.count(F.lit(1)).alias("n"))


def compare_names(
    raw: DataFrame | Mapping[str, DataFrame], dictionaries: Mapping[str, DataFrame]
) -> DataFrame:
    """Every name of either side: mentions in the raw layer, presence in the dictionary.

    Names are counted before they are compared, so a very common name is one row
    by the time of the join.  ``raw`` is one frame per dictionary, or a single one of
    (dictionary, name), or what ``mentions`` has made of these; store that for several
    comparisons.  ``coverage`` reads the result twice; store it when the raw layer is large.
    """
    counted = isinstance(raw, DataFrame) and "n" in raw.columns
    mentioned = raw if counted else mentions(raw)
    known = _labelled(dictionaries).distinct().withColumn("known", F.lit(True))
    return mentioned.join(known, ["dictionary", "name"], "full_outer")


def coverage(compared: DataFrame) -> DataFrame:
    """One row per dictionary: raw mentions, distinct names, missing names and a sample.

    All missing names are counted; the sample is the first few in order.
    """
    is_missing = F.col("known").isNull()
    totals = compared.groupBy("dictionary").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("ods_total_count"),
        F.count("n").alias("ods_unique_count"),
        F.count("known").alias("dds_unique_count"),
        F.count_if(is_missing).alias("missing_count"),
    )
    sample = first_values(compared.where(is_missing), "dictionary", "name", "missing_sample")
    return totals.join(sample, "dictionary", "left")


def first_values(
    df: DataFrame, group: str, value: str, out: str, size: int = SAMPLE_SIZE
) -> DataFrame:
    """The first few values of each group in order, comma-joined."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(value))
    few = df.select(group, value, place.alias("_place")).where(F.col("_place") <= size)
    return few.groupBy(group).agg(
        F.array_join(F.array_sort(F.collect_list(value)), ",").alias(out)
    )


def _labelled(frames: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    if isinstance(frames, DataFrame):
        return frames.select("dictionary", "name").where("name IS NOT NULL")
    parts = [
        df.select(F.lit(label).alias("dictionary"), "name").where("name IS NOT NULL")
        for label, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_names(raw: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct raw names the dictionary lacks."""
    once = raw.select("name").where("name IS NOT NULL").distinct()
    return once.join(dictionary.select("name"), "name", "left_anti")


def report(covered: DataFrame) -> DataFrame:
    mark = F.when(F.col("missing_count") == 0, "✓").otherwise("✗")
    return covered.select(
        "dictionary", "ods_total_count", "ods_unique_count", "dds_unique_count",
        mark.alias("coverage"),
    )


class CoverageError(ValueError):
    """Raised when a dictionary does not cover the raw layer."""


def gate(covered: DataFrame) -> None:
    """Fail when a dictionary lacks names; run it after the report is written."""
    gaps = covered.where("missing_count > 0").orderBy("dictionary").collect()
    if gaps:
        lines = [f"{g.dictionary}: {g.missing_count} missing, e.g. {g.missing_sample}" for g in gaps]
        raise CoverageError("; ".join(lines))


def total_and_unique(df: DataFrame, column: str) -> DataFrame:
    """Row count and distinct count, from one pre-aggregation."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_count"),
        F.count(column).alias("unique_count"),
    )


def with_volume(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass, as part of whatever job runs them."""
    seen = Observation(label)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def audit(df: DataFrame, spec: Table, targets: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per rule of one table; no rule is skipped, zero counts are listed."""
    checks = [_row_rules(df, spec)]
    checks += [_duplicates(df, [*cols], rule) for cols, rule in unique_rules(spec)]
    checks += [
        _orphans(df, column, targets[target])
        for column, target in spec.refs.items()
        if target in targets
    ]
    return reduce(DataFrame.unionByName, checks).select(
        F.lit(spec.name).alias("table_name"), "rule", "column_name", "violations"
    )


def unique_rules(spec: Table) -> list[tuple[Sequence[str], str]]:
    keyed = [(spec.key, "key")] if spec.key else []
    return keyed + [([column], "unique") for column in spec.unique]


def _row_rules(df: DataFrame, spec: Table) -> DataFrame:
    """NOT NULL and length rules of all columns in one pass."""
    rules = {("not_null", c): F.col(c).isNull() for c in spec.required}
    rules |= {("length", c): F.length(c) > n for c, n in spec.max_length.items()}
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.lit(column).alias("column_name"),
                    F.count_if(broken).alias("violations"),
                )
                for (rule, column), broken in rules.items()
            ]
        ).alias("checks")
    )
    return counts.select(F.inline("checks"))


def _duplicates(df: DataFrame, columns: Sequence[str], rule: str) -> DataFrame:
    repeated = df.groupBy(*columns).count().where("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(rule).alias("rule"), F.lit(",".join(columns)).alias("column_name"), "violations"
    )


def _orphans(df: DataFrame, column: str, target: DataFrame) -> DataFrame:
    """References to nothing; each referenced id is compared once."""
    used = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("id")).count()
    lost = used.join(target.select("id"), "id", "left_anti")
    return lost.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations")).select(
        F.lit("reference").alias("rule"), F.lit(column).alias("column_name"), "violations"
    )


def current_conflicts(dimension: DataFrame, key: str) -> DataFrame:
    """Keys with more than one live version."""
    live = dimension.where("is_current").groupBy(key).count()
    return live.where("count > 1").select(key, F.col("count").alias("live_versions"))
