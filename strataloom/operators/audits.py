"""Audit of a load: rules are checked on the parts it touched, the rest is carried forward.

A part is a partition of a table.  Rules on rows and on keys that hold the partition column
are broken within one part or not at all, so their counts add up over parts.  A reference
to nothing may be cured by a row that another table gets later; such references are kept
by id, and only they are compared again when the totals are read.  Rows of the tables
referred to are never removed, so a reference that held once still holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Table
from .quality import unique_rules

COUNTS = "part int, rule string, column_name string, violations long"
ORPHANS = "part int, column_name string, id string, n long"


@dataclass(frozen=True)
class PartAudit:
    """``counts`` of broken rules per part, zeros left out; ``orphans`` per part and id."""

    counts: DataFrame
    orphans: DataFrame


def audit_parts(df: DataFrame, spec: Table, targets: Mapping[str, DataFrame], part: str) -> PartAudit:
    """Every rule of ``spec`` on the rows given, per value of ``part``.

    ``part`` is an integer column that every unique key holds.  An empty table breaks no
    rule.  A common id is counted before it is compared.
    """
    keys = unique_rules(spec)
    loose = [",".join(columns) for columns, _ in keys if part not in columns]
    if loose:
        raise ValueError(f"{spec.name}: {part} is not in the key {loose[0]}")
    counts = [_row_rules(df, spec, part)]
    counts += [_repeated(df, [*columns], rule, part) for columns, rule in keys]
    lost = [
        _lost(df, column, targets[target], part)
        for column, target in spec.refs.items() if target in targets
    ]
    none = df.sparkSession.createDataFrame([], ORPHANS)
    return PartAudit(reduce(DataFrame.unionByName, counts), reduce(DataFrame.unionByName, lost, none))


def _row_rules(df: DataFrame, spec: Table, part: str) -> DataFrame:
    rules = {("not_null", c): F.col(c).isNull() for c in spec.required}
    rules |= {("length", c): F.length(c) > n for c, n in spec.max_length.items()}
    broken = [
        F.struct(
            F.lit(rule).alias("rule"), F.lit(column).alias("column_name"),
            F.count_if(condition).alias("violations"),
        )
        for (rule, column), condition in rules.items()
    ]
    per_part = df.groupBy(F.col(part).alias("part")).agg(F.array(*broken).alias("checks"))
    return per_part.select("part", F.inline("checks")).where("violations > 0")


def _repeated(df: DataFrame, columns: Sequence[str], rule: str, part: str) -> DataFrame:
    repeated = df.groupBy(*columns).count().where("count > 1")
    return repeated.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("violations")).select(
        "part", F.lit(rule).alias("rule"), F.lit(",".join(columns)).alias("column_name"), "violations"
    )


def _lost(df: DataFrame, column: str, target: DataFrame, part: str) -> DataFrame:
    used = df.where(F.col(column).isNotNull()).groupBy(
        F.col(part).alias("part"), F.col(column).cast("string").alias("id")
    ).agg(F.count(F.lit(1)).alias("n"))
    known = target.select(F.col("id").cast("string").alias("id"))
    return used.join(known, "id", "left_anti").select("part", F.lit(column).alias("column_name"), "id", "n")


def carried(before: PartAudit, fresh: PartAudit, parts: Sequence[int]) -> PartAudit:
    """The state after a load: ``parts`` as just audited, all others as they were."""
    kept = ~F.coalesce(F.col("part").isin(*parts), F.lit(False))
    return PartAudit(
        before.counts.where(kept).unionByName(fresh.counts),
        before.orphans.where(kept).unionByName(fresh.orphans),
    )


def totals(audit: PartAudit, spec: Table, targets: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per rule as ``quality.audit`` lists them, zero counts too."""
    found = [audit.counts.groupBy("rule", "column_name").agg(F.sum("violations").alias("violations"))]
    refs = {column: targets[target] for column, target in spec.refs.items() if target in targets}
    for column, target in refs.items():
        own = audit.orphans.where(F.col("column_name") == column)
        known = target.select(F.col("id").cast("string").alias("id"))
        still = own.join(known, "id", "left_anti").agg(F.sum("n").alias("violations"))
        found.append(still.select(F.lit("reference").alias("rule"), F.lit(column).alias("column_name"), "violations"))
    rules = [("not_null", c) for c in spec.required] + [("length", c) for c in spec.max_length]
    rules += [(rule, ",".join(columns)) for columns, rule in unique_rules(spec)]
    rules += [("reference", c) for c in refs]
    every = audit.counts.sparkSession.createDataFrame(rules, "rule string, column_name string")
    return every.join(reduce(DataFrame.unionByName, found), ["rule", "column_name"], "left").select(
        F.lit(spec.name).alias("table_name"), "rule", "column_name",
        F.coalesce("violations", F.lit(0)).alias("violations"),
    )
