"""What is derived, sorted, stored and read for large loads."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from strataloom.functions.records import with_tag_columns
from strataloom.functions.tags import TagVocabulary, classify_tags
from strataloom.operators import latest, quality, versions
from strataloom.plans import flows
from strataloom.plans.catalogue import loads
from strataloom.plans.given import MODEL_ORDER, Given
from strataloom.sources import staging

FROM_TAGS = {"tags", "language", "library", "task", "license", "base_models", "dataset", "arxiv"}


@pytest.fixture
def given(spark, tmp_path):
    """Two parts with two lines each, a line of no part and one without a part."""
    at = dt.datetime(1998, 1, 1)
    lines = [
        (17, 21, 1, 1.0, 9.5, 0.1, "O", at), (2, 21, 1, 2.0, 8.5, None, "F", at),
        (3, 32, 1, 3.0, 7.5, 0.2, "O", at), (3, 32, 2, None, None, 0.3, None, at),
        (4, 9, 1, 3.0, 7.5, 0.2, "O", at), (5, None, 1, 3.0, 7.5, 0.2, "O", None),
    ]
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(21, "a b", "Brand#1", "T X", 11), (32, "c", "Brand#22", None, 13)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
    ).write.parquet(f"{tmp_path}/part.parquet")
    return Given(spark, str(tmp_path))


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_a_load_is_reduced_before_its_tags_are_split(given, monkeypatch):
    reduced = []

    def latest(batch, key, order):
        reduced.append(batch.columns)
        return latest_by_key(batch, key, order)

    latest_by_key = flows.latest_by_key
    monkeypatch.setattr(flows, "latest_by_key", latest)
    load = loads.model_load(given)
    assert not FROM_TAGS & set(reduced[0])
    whole = flows.models_load(
        given.models, loads.no_rows(given, "dds.parties"), loads.no_rows(given, "dds.dim_models"),
        given.known_users, flows.StaticDimensions.generate(given.spark), loads.MODEL_LOAD, MODEL_ORDER,
    )
    assert rows(given.whole_models(given.model_heads)) == rows(given.models)
    for name, bridge in whole.rows.items():
        assert rows(load.rows[name]) == rows(bridge)
    assert load.rows["dds.bridge_models_datasets"].count() > 0
    assert rows(load.rejects) == rows(whole.rejects)


def test_staged_lines_are_compressed_and_files_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "FILE_ROWS", 10, raising=False)
    df = spark.range(25).coalesce(1).select(F.col("id").cast("string").alias("id"))
    path = staging.write_staged_json(df, str(tmp_path), "models", "raw", "20240301T000000")
    assert len(glob.glob(f"{path}/*.json.gz")) == 3
    assert rows(staging.scan_json_lines(spark, path, "id string")) == rows(df)


def test_tag_columns_that_nobody_reads_are_not_derived(spark):
    tags = [
        ["en", "EN", "PyTorch", "license:a", "license:b", None, "arxiv:1", "base_model:x",
         "base_model:merge:y", "text-generation", "base_model:", "deploy:z", "region:us"],
        [], None, [None, ":"],
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "id int, tags array<string>")
    vocabulary = TagVocabulary.standard(spark)
    split = with_tag_columns(df, vocabulary)
    plan = split.select("license", "region")._jdf.queryExecution().optimizedPlan().toString()
    assert "license:" in plan and "arxiv:" not in plan
    assert rows(split) == rows(df.select("id", classify_tags(F.col("tags"), vocabulary).alias("t")).select("id", "t.*"))
    first = split.where("id = 0").first()
    assert (first.language, first.library, first.task) == (["en"], ["pytorch"], ["text-generation"])
    assert (first.license, first.modification, first.arxiv) == ("b", "merge", 1)


def test_counted_mentions_are_compared_like_raw_names(spark):
    raw = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "name string")
    known = {"d": spark.createDataFrame([("b",), ("c",)], "name string")}
    counted = quality.mentions({"d": raw})
    assert rows(counted) == rows(spark.createDataFrame([("d", "a", 2), ("d", "b", 1)], "dictionary string, name string, n long"))
    assert rows(quality.compare_names(counted, known)) == rows(quality.compare_names({"d": raw}, known))


def test_a_load_of_versions_is_reduced_before_it_is_hashed(spark, tmp_path, monkeypatch):
    old, new = dt.datetime(1998, 1, 1), dt.datetime(2001, 6, 1)
    lines = [
        (1, 21, 1, 1.0, 9.5, 0.1, "O", old), (2, 21, 1, 2.0, 8.5, 0.1, "F", old + dt.timedelta(1)),
        (3, 21, 2, 2.0, 8.5, 0.1, "F", new), (4, 21, 2, 2.0, 8.5, 0.1, "O", new + dt.timedelta(1)),
        (5, 32, 1, 3.0, 7.5, 0.2, "O", old), (6, 32, 1, 3.0, 7.5, 0.2, "O", new),
        (7, 43, 3, None, None, None, None, new), (8, 54, 1, 1.0, 1.0, 0.1, "F", old), (9, 65, 1, 1.0, 1.0, 0.1, "F", new),
    ]
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(21, "a b", "Brand#1", "T X", 11), (32, "c", "Brand#22", None, 13), (43, None, "Brand#3", "U", None),
         (54, "e", "Brand#4", "V", 15), (65, "f", "Brand#5", "W", 20)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
    ).write.parquet(f"{tmp_path}/part.parquet")
    given = Given(spark, str(tmp_path))

    reduced = []
    latest_by_key = latest.latest_by_key

    def noted(batch, key, order):
        reduced.append(batch.columns)
        return latest_by_key(batch, key, order)

    monkeypatch.setattr(latest, "latest_by_key", noted)
    found = loads.scd2_models(given)
    assert len(reduced) == 1 and not {"hashdiff", "license", *FROM_TAGS} & set(reduced[0])

    whole = loads.model_rows(given)
    load = whole.agg(F.max("loaded_at").cast("string")).first()[0]
    live = versions.rebuild_versions(
        whole.where(F.col("loaded_at") < F.lit(loads.MODEL_CUT)), "name", order=MODEL_ORDER[1:]
    ).where("is_current")
    change = versions.apply_versions(
        live, latest_by_key(whole.where(F.col("loaded_at") >= F.lit(loads.MODEL_CUT)), ["name"], MODEL_ORDER),
        "name", dt.datetime.fromisoformat(load).replace(tzinfo=dt.timezone.utc),
    )
    wanted = change.current.unionByName(change.closed)
    assert rows(found) == rows(loads._shown(wanted, "name", "license", "hashdiff"))
    assert sorted(found.groupBy("name").count().select("count").toPandas()["count"]) == [1, 1, 1, 2]


def test_all_tags_are_passed_over_once_for_each_group(spark):
    tags = [
        ["base_model:a:", "base_model:b", "dataset:", "dataset:a:b", "d", "deploy", "deploy:x", "deploy:y", "license"],
        ["base_model:b", "base_model::x", "DATASET:a", "diffusers:p", "diffusers:q:r", "arxiv:", ":", "", "arxiv"],
        ["License:a", "license:", "region:a:b", "en:x", "a:b", "A:B", "license:z", None],
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "id int, tags array<string>")
    split = with_tag_columns(df, TagVocabulary(("en:x", "d"), ("a:b",), ("license",)))
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(tags#") == 3
    names = [c for c in split.columns if c != "id"]
    assert names == [
        "language", "library", "task", "license", "base_models", "modification", "region",
        "diffusers_pipeline", "deploy", "dataset", "arxiv",
    ]
    assert [tuple(r) for r in split.orderBy("id").select(names).collect()] == [
        (["d"], None, ["license"], None, ["", "b"], "a", None, None, "x", ["", "a:b"], 0),
        (None, None, None, None, ["b", "x"], "", None, "q:r", None, None, 1),
        (["en:x"], ["a:b", "a:b"], None, "z", None, None, "a:b", None, None, None, 0),
    ]
