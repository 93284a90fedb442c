"""Versioned dimensions: folding loads equals rebuilding from their history."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataloom.operators import latest, versions

UTC = dt.timezone.utc
SCHEMA = "name string, colour string, hashdiff string, loaded_at timestamp, position long"


def day(n):
    return dt.datetime(2024, 1, n, tzinfo=UTC)


LOADS = 4


def history(seed, loads=LOADS, rows=40):
    """Rows of several loads, one hot key among them and repeats within a load."""
    rng = random.Random(seed)
    out = []
    for load in range(1, loads + 1):
        for position in range(rows):
            name = "hot" if rng.random() < 0.3 else f"k{rng.randrange(12)}"
            colour = rng.choice(["red", "green"])
            out.append((name, colour, colour[0], day(load), position))
    return out


def keyed(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


ALL = ("id", "name", "colour", "hashdiff", "valid_from", "valid_to", "is_current")


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_rebuild(spark, seed):
    rows = spark.createDataFrame(history(seed), SCHEMA)
    rebuilt = versions.rebuild_versions(rows, "name", order=["position"])

    live = rebuilt.limit(0)
    ended = rebuilt.limit(0)
    for load in range(1, LOADS + 1):
        batch = rows.where(F.col("loaded_at") == F.lit(day(load)))
        incoming = latest.latest_by_key(batch, ["name"], ["position"])
        change = versions.apply_versions(live, incoming, "name", day(load))
        assert change.inserted.count() + change.unchanged.count() == incoming.count()
        again = versions.apply_versions(change.current, incoming, "name", day(load))
        assert again.inserted.count() == again.closed.count() == 0
        ended = spark.createDataFrame(ended.unionByName(change.closed).collect(), ended.schema)
        live = spark.createDataFrame(change.current.collect(), live.schema)
    assert keyed(live.unionByName(ended), *ALL) == keyed(rebuilt, *ALL)


def test_versions_are_contiguous_with_one_live_each(spark):
    rows = spark.createDataFrame(history(9), SCHEMA)
    built = versions.rebuild_versions(rows, "name", order=["position"])
    following = F.lead("valid_from").over(Window.partitionBy("name").orderBy("valid_from"))
    gaps = built.withColumn("next", following).where("next IS NOT NULL AND next <> valid_to")
    assert gaps.count() == 0
    assert built.where("is_current").count() == built.select("name").distinct().count()


def test_absent_keys_stay_and_missing_columns_are_refused(spark):
    rows = spark.createDataFrame([("a", "red", "r", day(1), 1)], SCHEMA)
    live = versions.rebuild_versions(rows, "name", order=["position"])
    nothing = rows.limit(0)
    change = versions.apply_versions(live, nothing, "name", day(2))
    assert keyed(change.current, *ALL) == keyed(live, *ALL)
    with pytest.raises(ValueError, match="colour"):
        versions.apply_versions(live, nothing.drop("colour"), "name", day(2))


@pytest.mark.parametrize("unit", ["day", "month"])
def test_as_of_join_against_brute_force(spark, unit):
    rows = spark.createDataFrame(history(5), SCHEMA)
    built = versions.rebuild_versions(rows, "name", order=["position"])
    rng = random.Random(7)
    facts = [
        (i, rng.choice(["hot", "k1", "k2", "none"]), day(1) + dt.timedelta(hours=rng.randrange(-48, 400)))
        for i in range(300)
    ]
    df = spark.createDataFrame(facts, "fact long, name string, ts timestamp")
    got = versions.as_of_join(df, built, "name", "ts", unit)
    spans = built.select("name", "id", "valid_from", "valid_to").collect()
    expected = sorted(
        (f.fact, v.id)
        for f in df.collect()
        for v in spans
        if v.name == f.name and v.valid_from <= f.ts < v.valid_to
    )
    assert keyed(got, "fact", "id") == expected


def test_upsert_keeps_one_row_per_key(spark):
    base = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, h int, v int")
    load = spark.createDataFrame(
        [("a", 1, 11, 1), ("a", 1, 12, 2), ("c", 1, 30, 1)], "k string, h int, v int, position int"
    )
    once = latest.upsert_latest(base, load, ["k", "h"], ["position"])
    assert keyed(once, "k", "h", "v") == [("a", 1, 12), ("b", 1, 20), ("c", 1, 30)]
    twice = latest.upsert_latest(once, load, ["k", "h"], ["position"])
    assert keyed(twice, "k", "h", "v") == keyed(once, "k", "h", "v")
    touched = latest.touched_partitions(base, load.where("k = 'c'"), ["k", "h"], ["position"], "h")
    assert keyed(touched, "k") == [("a",), ("b",), ("c",)]
