"""Percentiles, ranks and feed pages against brute force."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from strataloom.operators import ranking
from strataloom.sources import feed


@pytest.mark.parametrize("size", [1, 2, 7, 5000])
@pytest.mark.parametrize("seed", [1, 2])
def test_median_is_exact(spark, size, seed):
    rng = random.Random(seed)
    rows = [
        (group, rng.choice([1.0, 2.0, rng.random() * 50]))
        for group in ("a", "b", None) for _ in range(size)
    ]
    df = spark.createDataFrame([*rows, ("a", None)], "g string, v double")
    got = {r.g: r.percentile for r in ranking.percentile_by(df, ["g"], "v").collect()}
    for group in ("a", "b", None):
        values = [v for g, v in rows if g == group]
        assert got[group] == pytest.approx(statistics.median(values), abs=1e-12)


def test_upper_percentile(spark):
    df = spark.range(1001).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    assert ranking.percentile_by(df, ["g"], "v", 0.999).first().percentile == 999.0


@pytest.mark.parametrize("share", [0.0, 0.37, 0.5, 1.0])
def test_missed_brackets_are_widened(spark, monkeypatch, share):
    """Coarse sketches miss: ties by the thousand, one group far larger than the others."""
    rng = random.Random(11)
    rows = [("big", float(rng.choice([0, 1, 1, 1, rng.randint(2, 10**6)]))) for _ in range(6000)]
    rows += [("ties", float(v)) for v in [7] * 900 + [8] * 901 + [9]]
    rows += [(g, rng.random()) for g in ("s1", "s2", None) for _ in range(rng.randint(1, 40))]
    passes = []
    once = ranking._picked
    monkeypatch.setattr(ranking, "_picked", lambda *a: passes.append(a[3]) or once(*a))
    monkeypatch.setattr(ranking, "_SLACK", 1e-9)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r.percentile for r in ranking.percentile_by(df, ["g"], "v", share, accuracy=20).collect()}
    for group in ("big", "ties", "s1", "s2", None):
        values = sorted(v for g, v in rows if g == group)
        at = (len(values) - 1) * share
        low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
        assert got.pop(group) == pytest.approx(low + (high - low) * (at - int(at)), abs=1e-9)
    assert not got
    assert share in (0.0, 1.0) or len(passes) > 1
    assert passes == sorted(passes)


def test_ranks_with_ties(spark):
    df = spark.createDataFrame(
        [("a", 5), ("b", 9), ("c", 9), ("d", 5), ("e", 5), ("f", None)], "n string, v int"
    )
    got = ranking.ranked_top_k(df, 4, "v", ["n"]).collect()
    assert [(r.n, r["rank"]) for r in got] == [("b", 1), ("c", 1), ("a", 3), ("d", 3)]


@pytest.mark.parametrize("recent", [0, 1, 9, 10, 11, 25, 40])
def test_feed_pages(spark, recent):
    now = dt.datetime(2024, 5, 2, tzinfo=dt.timezone.utc)
    items = [(i, now - dt.timedelta(minutes=i)) for i in range(recent)]
    items += [(i, now - dt.timedelta(days=2, minutes=i)) for i in range(recent, 40)]
    df = spark.createDataFrame(items, "item long, at timestamp")
    kept = []
    for start in range(0, 40, 10):
        page = items[start:start + 10]
        kept += [i for i, _ in page]
        if page[-1][1] < now - dt.timedelta(hours=24):
            break
    got = feed.recent_feed(df, now, F.col("at"), "item", exact=False)
    assert sorted(r.item for r in got.collect()) == kept
    exact = feed.recent_feed(df, now, F.col("at"), "item")
    assert sorted(r.item for r in exact.collect()) == list(range(recent))
