"""The physical plans are the ones meant for large tables."""

import datetime as dt
import re

from pyspark.sql import functions as F

from strataloom.functions.tags import TagVocabulary, classify_tags
from strataloom.operators import latest, marts
from strataloom.plans.given import AS_OF, Given

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v", "id AS unused")
    text = plan(latest.latest_by_key(df, ["k"], ["v"]).select("k", "v"))
    assert text.count("WindowGroupLimit") == 2
    assert "unused" not in text


def test_tag_dictionaries_are_hash_sets(spark):
    df = spark.createDataFrame([(["en"],)], "tags array<string>")
    text = plan(df.select(classify_tags(F.col("tags"), TagVocabulary.standard(spark))))
    assert "INSET" in text and "BatchEvalPython" not in text


def test_leaderboard_cuts_before_it_ranks(spark):
    text = plan(marts.leaderboard(Given(spark, SF_DIR).detail, AS_OF))
    assert text.index("Window [rank") < text.index("TakeOrderedAndProject")


def test_batch_filter_prunes_partitions(spark, tmp_path):
    from strataloom.sources import tables

    moment = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    tables.append_batch(spark.range(3).toDF("n"), str(tmp_path / "t"), moment)
    stored = spark.read.schema("n long, loaded_at timestamp").parquet(str(tmp_path / "t"))
    text = plan(tables.batch_scan(stored, moment, ["n"]))
    assert "PartitionFilters: [isnotnull(loaded_at" in text


def test_a_load_reads_each_side_once(spark, tmp_path):
    """One join of live and incoming rows is stored; every part of the change reads that."""
    from strataloom.operators import versions

    moment = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = spark.range(20).selectExpr("concat('k', id) AS name", "'h' AS hashdiff")
    rows.write.parquet(str(tmp_path / "new"))
    incoming = spark.read.parquet(str(tmp_path / "new"))
    built = versions.rebuild_versions(
        rows.withColumn("loaded_at", F.lit(moment - dt.timedelta(days=1))), "name"
    )
    built.write.parquet(str(tmp_path / "live"))
    live = spark.read.parquet(str(tmp_path / "live"))
    text = plan(versions.joined_change(live, incoming, "name", moment))
    assert text.count("FileScan") == 2 and text.count("Join") == 1
    change = versions.apply_versions(live, incoming, "name", moment)
    for part in (change.current, change.closed, change.spoken):
        assert plan(part).count("FileScan") == 1 and "Join" not in plan(part)


def test_only_touched_days_are_read(spark, tmp_path):
    days = spark.range(30).selectExpr("id AS v", "cast(20240101 + id AS int) AS day")
    days.write.partitionBy("day").parquet(str(tmp_path / "facts"))
    base = spark.read.parquet(str(tmp_path / "facts"))
    batch = base.where("day = 20240107").withColumn("position", F.lit(1))
    touched = latest.touched_partitions(base, batch, ["v"], ["position"], "day")
    assert "PartitionFilters: [isnotnull(day" in plan(touched) and "20240107" in plan(touched)
    assert touched.count() == 1


def exchanges_above_facts(df):
    """Exchanges between the fact scan and the join with the models in the final plan."""
    df.collect()
    text = plan(df)
    return text, re.findall(r"Exchange hashpartitioning\((?:model_id|id)#", text)


def test_clustered_facts_meet_models_without_an_exchange(spark):
    from strataloom.plans.catalogue import joins

    # The given tables are small enough to broadcast; large ones are not.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        detail = Given(spark, SF_DIR).detail
        plain, found = exchanges_above_facts(joins._by_license(detail))
        assert found and "Bucketed: true" not in plain
        laid = joins.clustered_detail(detail)
        for build in (joins._by_license, joins._star):
            text, found = exchanges_above_facts(build(laid))
            assert found == [] and text.count("Bucketed: true") >= 2, text
            assert "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_scanned(df):
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def test_a_look_up_in_a_sorted_table_reads_few_rows(spark, tmp_path):
    from strataloom.sources import clustered, tables

    moment, n = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), 60_000
    rows = spark.range(n).selectExpr("concat('slug-', lpad(pmod(id * 7919, 60000), 6, '0')) AS slug", "repeat('x', 40) AS content")
    clustered.append_sorted(rows, str(tmp_path / "sorted"), moment, ["slug"])
    clustered.append_sorted(rows, str(tmp_path / "sorted"), moment, ["slug"])
    tables.append_batch(rows.repartition(4), str(tmp_path / "plain"), moment)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for name in ("sorted", "plain"):
            table = spark.read.parquet(str(tmp_path / name))
            assert table.count() == n
            found = table.where("slug = 'slug-031415'").select("content")
            read[name] = rows_scanned(found)
            assert found.count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # One page of one file, a thirtieth of the table at most.
    assert read["sorted"] <= 2 * clustered.PAGE_ROWS <= n / 15
    assert read["plain"] > n / 2


def test_sketches_are_merged_without_the_rows(spark, tmp_path):
    from strataloom.operators import sketches

    rows = spark.range(40_000).selectExpr("id % 9 AS day", "CASE WHEN id % 3 > 0 THEN 'a' END AS label", "id % 7001 AS model")
    rows.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    sketches.daily_sketches(facts, "day", ["label"], "model").write.parquet(str(tmp_path / "daily"))
    merged = sketches.merged_distinct(spark.read.parquet(str(tmp_path / "daily")).where("day < 5"), ["label"])
    assert str(tmp_path / "facts") not in plan(merged)
    exact = {r.label: r.n for r in facts.where("day < 5").groupBy("label").agg(F.count_distinct("model").alias("n")).collect()}
    got = {r.label: r.estimate for r in merged.collect()}
    assert got.keys() == exact.keys()
    for label, n in exact.items():
        assert abs(got[label] - n) <= sketches.ERRORS * sketches.STANDARD_ERROR * n + 0.5
