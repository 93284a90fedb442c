"""The audit of loads against the audit of whole tables."""

import random

import pytest

from strataloom.operators import audits, quality
from strataloom.schemas import Table

SPEC = Table(
    "t.facts", "a string, b string, day int, n long", key=("a", "day"), refs={"a": "t.names", "b": "t.other"},
    required=("a", "n"), max_length={"b": 2}, partition_by=("day",),
)
DDL = "a string, b string, day int, n long"


def shown(df):
    return sorted((r.rule, r.column_name, r.violations) for r in df.collect())


def batch(rng, days):
    """Rows that break every rule, a third of them with one id."""
    return [
        (rng.choice(["hot"] * 3 + ["x", "y", None, *map(str, range(5))]), rng.choice(["p", "qq", "rrr", None]),
         rng.choice(days), rng.choice([1, 2, None]))
        for _ in range(60)
    ]


def test_three_loads_equal_the_full_audit(spark):
    rng = random.Random(5)
    stored, names = {}, []
    state = audits.PartAudit(spark.createDataFrame([], audits.COUNTS), spark.createDataFrame([], audits.ORPHANS))
    for days, new in (([1, 2, 3], ["x"]), ([3, 4], ["hot"]), ([2, 5], ["0", "1"])):
        names += new
        targets = {
            "t.names": spark.createDataFrame([(n,) for n in names], "id string"),
            "t.other": spark.createDataFrame([("p",)], "id string"),
        }
        for row in batch(rng, days):
            stored.setdefault(row[2], []).append(row)
        touched = spark.createDataFrame([r for d in days for r in stored.get(d, [])], DDL)
        fresh = audits.audit_parts(touched, SPEC, targets, "day")
        state = audits.carried(state, fresh, days)
        state = audits.PartAudit(*(spark.createDataFrame(f.collect(), f.schema) for f in (state.counts, state.orphans)))
        whole = spark.createDataFrame([r for rows in stored.values() for r in rows], DDL)
        want = shown(quality.audit(whole, SPEC, targets))
        assert shown(audits.totals(state, SPEC, targets)) == want
    assert sum(v > 0 for _, _, v in want) >= 5


def test_an_emptied_part_and_an_empty_table(spark):
    targets = {"t.names": spark.createDataFrame([], "id string")}
    rows = spark.createDataFrame([("x", "ppp", 1, None), ("x", "p", 2, 1)], DDL)
    state = audits.audit_parts(rows, SPEC, targets, "day")
    none = audits.audit_parts(rows.limit(0), SPEC, targets, "day")
    assert {v for _, _, v in shown(audits.totals(none, SPEC, targets))} == {0}
    left = audits.carried(state, none, [1])
    assert shown(audits.totals(left, SPEC, targets)) == [
        ("key", "a,day", 0), ("length", "b", 0), ("not_null", "a", 0), ("not_null", "n", 0), ("reference", "a", 1)]


def test_keys_without_the_part_are_refused(spark):
    loose = Table("t.loose", DDL, key=("a",), partition_by=("day",))
    with pytest.raises(ValueError, match="t.loose"):
        audits.audit_parts(spark.createDataFrame([], DDL), loose, {}, "day")
