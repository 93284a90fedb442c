"""Expressions on the awkward values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataloom.functions import html, keys, moments, numbers, text
from strataloom.functions.tags import TagVocabulary, classify_tags, extract_owner
from strataloom.functions.vocabulary import languages


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [(" a b ", "a b"), (" x\xa0", "x"), ("\x1cx\x85", "x"), (" \t\n", None), (None, None)],
)
def test_strip_to_null(spark, raw, expected):
    assert one(spark, raw, "string", text.strip_to_null) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05.000Z", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05+02:00", dt.datetime(2024, 1, 2, 1, 4, 5)),
        ("2024-01-02T03:04:05", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02", dt.datetime(2024, 1, 2)),
        ("soon", None),
        ("12:30:00", None),
        ("T12", None),
        ("2024", None),
        (None, None),
    ],
)
def test_parse_iso(spark, raw, expected):
    shown = one(spark, raw, "string", lambda c: F.date_format(moments.parse_iso(c), "yyyy-MM-dd HH:mm:ss"))
    assert shown == (expected and expected.strftime("%Y-%m-%d %H:%M:%S"))


@pytest.mark.parametrize(
    ("raw", "expected"), [(None, 0), (float("nan"), 0), (2.9, 2), (-2.9, -2)]
)
def test_safe_int(spark, raw, expected):
    assert one(spark, raw, "double", numbers.safe_int) == expected


def test_safe_int_keeps_long_numbers(spark):
    assert one(spark, 9007199254740993, "long", numbers.safe_int) == 9007199254740993


def test_rounding_is_half_up(spark):
    assert str(one(spark, 0.0005, "double", lambda c: numbers.round_half_up(c, 3))) == "0.001"
    assert str(one(spark, -2.5, "double", lambda c: numbers.round_half_up(c, 0))) == "-3"


def test_likes_ratio_without_downloads(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "likes long, downloads long")
    got = df.select(numbers.likes_ratio(F.col("likes"), F.col("downloads"))).collect()
    assert [str(r[0]) for r in got] == ["None", "0.3333"]


def test_party_hash_has_a_separator(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "n string, t string")
    got = {r[0] for r in df.select(keys.party_hash(F.col("n"), F.col("t"))).collect()}
    assert len(got) == 2


def test_hashdiff_ignores_list_order_and_spells_null(spark):
    df = spark.createDataFrame(
        [("a", ["y", "x"]), ("a", ["x", "y"]), (None, [])], "s string, l array<string>"
    )
    got = [r[0] for r in df.select(keys.hashdiff([F.col("s")], [F.col("l")])).collect()]
    assert got[0] == got[1]
    assert got[2] == one(spark, "None|None", "string", F.md5)


def test_language_registry(spark):
    found = languages(spark)
    codes = [c for c, _ in found]
    assert len(codes) == len(set(codes)) == 386
    assert [len(c) for c in codes] == [2] * 183 + [3] * 203
    assert dict(found)["chi"] == dict(found)["zh"] == "Chinese"
    assert dict(found)["mao"] == "`Maori`" and dict(found)["mi"] == "Maori"
    assert dict(found)["cu"] == dict(found)["chu"] == "Church Slavonic"


TAGS = [
    "en", "EN", "PyTorch", "timm", "text-generation", "license:mit", "license:apache-2.0",
    "base_model:org/a", "base_model:finetune:org/b", "region:us", "diffusers:Pipe:line",
    "deploy:first", "deploy:second", "dataset:d1", "dataset:d2", "arxiv:1", "arxiv:2",
    "unknown", None,
]


@pytest.mark.parametrize("strict", [False, True])
def test_classify_tags(spark, strict):
    vocabulary = TagVocabulary.standard(spark, strict=strict)
    df = spark.createDataFrame([(TAGS,), ([],), (None,)], "tags array<string>")
    first, empty, absent = df.select(classify_tags(F.col("tags"), vocabulary).alias("t")).select("t.*").collect()
    assert first.language == ["en"]
    assert first.library == (["timm"] if strict else ["pytorch", "timm"])
    assert first.task == (None if strict else ["text-generation"])
    assert first.license == "apache-2.0"
    assert first.base_models == ["org/a", "org/b"] and first.modification == "finetune"
    assert first.region == "us" and first.diffusers_pipeline == "Pipe:line"
    assert first.deploy == "first" and first.dataset == ["d1", "d2"] and first.arxiv == 2
    for row in (empty, absent):
        assert row.arxiv == 0 and all(v is None for k, v in row.asDict().items() if k != "arxiv")


def test_owner(spark):
    assert one(spark, "org/name", "string", extract_owner) == "org"
    assert one(spark, "name", "string", extract_owner) is None


def test_linked_ids(spark):
    page = """
      <a href="/papers/2401.00001">a</a> <A class=z href='/papers/2401.00002/'>b</A>
      <a href=/papers/2401.00001>again</a> <a href="/papers/2401.00003#c">no</a>
      <a href="/papers/2401.3">no</a> <a data-href="/papers/2401.00004">no</a>
      <!-- <a href="/papers/2401.00005">no</a> --> <script>"<a href='/papers/2401.00006'>"</script>
      <link href="/papers/2401.00007"> <a href="https://h/papers/x/papers/2401.00008">c</a>
    """
    assert one(spark, page, "string", html.linked_ids) == ["2401.00001", "2401.00002", "2401.00008"]


def test_not_blank_forms(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "x string")
    x = F.col("x")
    kept = lambda p: [r.x for r in df.where(p).collect()]
    assert kept(text.not_blank(x)) == ["a"]
    assert kept(text.not_blank(x, drop_empty=False)) == ["a", ""]
    assert kept(text.not_blank(x, drop_null=False)) == ["a", None]
