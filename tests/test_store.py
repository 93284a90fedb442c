"""Landing files, stored tables, whole loads and their repetition."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from strataloom.functions.records import project_models, project_papers, project_posts
from strataloom.functions.tags import TagVocabulary
from strataloom.operators import marts, quality
from strataloom.plans import flows
from strataloom.schemas import RAW_MODEL, RAW_PAPER, RAW_POST, TABLES, table
from strataloom.sources import audit_log, days, ledger, staging, tables

UTC = dt.timezone.utc
FIRST, SECOND = dt.datetime(2024, 3, 1, 5, tzinfo=UTC), dt.datetime(2024, 3, 2, 5, tzinfo=UTC)


def model(name, **fields):
    base = {"id": name, "created_at": "2023-05-05T10:30:00Z", "downloads": 5, "likes": 1,
            "trending_score": 1.5, "tags": ["en", "PyTorch", "dataset:d1", "license:mit"]}
    return base | fields


MODELS = [
    [model("org/a"), model("org/b", downloads=None, trending_score=float("nan")), model("orphan"),
     model("org/old", created_at="1999-12-31T23:00:00Z"), model("ann/c", tags=[])],
    [model("org/a", downloads=7), model("org/b", tags=["de", "license:apache-2.0"]), model("org/d")],
]


@pytest.fixture
def home(spark, tmp_path):
    made = tables.Warehouse(spark, str(tmp_path), f"t{uuid.uuid4().hex[:8]}_")
    made.init_tables()
    made.init_tables()
    return made


def raw(spark, records, ddl, loaded_at):
    df = spark.createDataFrame(spark.sparkContext.emptyRDD(), ddl)
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "line string")
    parsed = lines.select(
        F.from_json("line", ddl, {"allowNonNumericNumbers": "true"}).alias("r")
    ).select("r.*")
    return df.unionByName(parsed).withColumns(
        {"loaded_at": F.lit(loaded_at), "position": F.monotonically_increasing_id()}
    )


def load_models(spark, home, records, moment):
    batch = project_models(raw(spark, records, RAW_MODEL, moment), TagVocabulary.standard(spark))
    users = spark.createDataFrame([("ann",)], "name string")
    load = flows.models_load(
        batch, home.live("dds.parties"), home.live("dds.dim_models"), users,
        flows.StaticDimensions.generate(spark), moment, ["position"],
    )
    rejects = {(r.key, r.reason) for r in load.rejects.collect()}
    flows.commit(home, load)
    return rejects


def state(home):
    names = [n for n in TABLES if n.startswith("dds.") and "post" not in n and "paper" not in n]
    return {n: sorted(map(str, home.frame(n).collect())) for n in names}


def test_model_loads(spark, home):
    flows.store_static(home, flows.StaticDimensions.generate(spark))
    flows.store_static(home, flows.StaticDimensions.generate(spark))
    assert home.frame("dds.dim_languages").count() == 386
    assert home.frame("dds.dim_date").count() == 11323

    rejects = load_models(spark, home, MODELS[0], FIRST)
    assert rejects == {("orphan", "no_owner"), ("org/old", "no_created_date")}
    load_models(spark, home, MODELS[1], SECOND)
    done = state(home)
    load_models(spark, home, MODELS[1], SECOND)
    assert state(home) == done, "a repeated load changes nothing"

    parties = {r.name: r.type for r in home.frame("dds.parties").where("is_current").collect()}
    assert parties == {"org": "org", "ann": "user"}
    versions = home.frame("dds.dim_models").groupBy("name").count().collect()
    assert {r.name: r["count"] for r in versions} == {"org/a": 1, "org/b": 2, "ann/c": 1, "org/d": 1}
    metrics = home.frame("dds.fact_models_metrics").join(
        home.frame("dds.dim_models").select(F.col("id").alias("model_id"), "name"), "model_id"
    )
    found = {(r.name, r.date_id): (r.downloads, r.trending_score) for r in metrics.collect()}
    assert found == {
        ("org/a", 20240301): (5, 1.5), ("org/b", 20240301): (0, 0.0), ("ann/c", 20240301): (5, 1.5),
        ("org/a", 20240302): (7, 1.5), ("org/b", 20240302): (5, 1.5), ("org/d", 20240302): (5, 1.5),
    }
    assert home.frame("dds.bridge_models_libraries").count() == 3
    assert home.frame("dds.bridge_models_languages").count() == 4

    targets = {n: home.frame(n) for n in TABLES if n.startswith("dds.")}
    for name in ("dds.dim_models", "dds.fact_models_metrics", "dds.bridge_models_tasks"):
        broken = quality.audit(home.frame(name), table(name), targets).where("violations > 0")
        assert broken.collect() == [], name


def test_a_load_touches_the_buckets_of_its_keys(spark, home):
    """Bytes read and written follow the load, also when a run died between two writes."""
    static = flows.StaticDimensions.generate(spark)
    flows.store_static(home, static)

    def post(slug, content, author):
        return {
            "slug": slug, "author": {"name": author}, "rawContent": content,
            "publishedAt": "2024-02-29T10:00:00.000Z", "updatedAt": None,
            "totalUniqueImpressions": 1, "numComments": 2, "reactions": [], "mentions": [], "attachments": [],
        }

    def load(moment, *posts):
        batch = project_posts(raw(spark, list(posts), RAW_POST, moment))
        return flows.posts_load(
            batch, home.live("dds.parties"), home.live("dds.dim_posts"), static, moment, ["position"]
        )

    def files(name):
        found = spark.table(f"{home.prefix}{name}").select("bucket", F.input_file_name().alias("file")).distinct()
        return {r.bucket: r.file for r in found.collect()}

    flows.commit(home, load(FIRST, *[post(f"s{i}", "x", f"a{i}") for i in range(60)]))
    before = files("dds.dim_posts_live")
    assert len(before) > 40
    second = load(SECOND, post("s1", "y", "a1"), post("new", "z", "a1"))
    buckets = {r.bucket for r in second.versions["dds.dim_posts"].spoken.collect()}
    text = second.versions["dds.dim_posts"].current.select("slug").collect()
    assert len(buckets) == 2 and len(text) < 10
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", None)
    # A run that dies after the ended versions and before the live ones.
    change = second.versions["dds.dim_posts"]
    home._overwrite_partitions(
        change.closed.drop("is_current").withColumn("ended_by", F.lit("20240302T050000000000")), "dds.dim_posts_ended"
    )
    flows.commit(home, second)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", None) == mode
    after = files("dds.dim_posts_live")
    assert {b for b in after if after[b] != before.get(b)} == buckets
    for _ in range(2):
        state = {(r.slug, r.content_raw, r.is_current) for r in home.frame("dds.dim_posts").collect()}
        assert state >= {("s1", "x", False), ("s1", "y", True), ("new", "z", True)} and len(state) == 62
        flows.commit(home, load(SECOND, post("s1", "y", "a1"), post("new", "z", "a1")))


@pytest.mark.parametrize("dies_at", ["dds.bridge_models_tasks", "dds.dim_models", "dds.parties"])
def test_an_unfinished_load_is_invisible(spark, home, monkeypatch, dies_at):
    """A load killed between two tables is not seen, and repeating it completes it."""
    flows.store_static(home, flows.StaticDimensions.generate(spark))
    names = [n for n in TABLES if n.startswith("dds.") and ("model" in n or n == "dds.parties")]

    def rows(frame_of):
        return {n: sorted(str(r) for r in frame_of(n).select(*table(n).column_names).collect()) for n in names}

    def seen():
        return rows(lambda n: ledger.visible(home, n))

    def everything():
        return rows(home.frame)

    load_models(spark, home, MODELS[0], FIRST)
    before = seen()
    assert before == everything()

    written = []
    for step in ("append", "commit_partitions", "commit_versions"):
        whole = getattr(tables.Warehouse, step)

        def broken(self, df, name, *rest, whole=whole):
            if name == dies_at:
                raise OSError("lost")
            written.append(name)
            return whole(self, df, name, *rest)

        monkeypatch.setattr(tables.Warehouse, step, broken)
    with pytest.raises(OSError, match="lost"):
        load_models(spark, home, MODELS[1], SECOND)
    monkeypatch.undo()
    assert written and dies_at not in written
    assert ledger.Ledger(home).unfinished() == [SECOND]
    assert seen() == before
    load_models(spark, home, MODELS[1], SECOND)
    assert ledger.Ledger(home).unfinished() == []
    assert {r.loaded_at.day for r in ledger.Ledger(home).finished().collect()} == {1, 2}
    after = seen()
    assert after == everything()
    assert len(after["dds.dim_models"]) == 5 and len(after["dds.fact_models_metrics"]) == 6


def test_posts_and_papers(spark, home):
    static = flows.StaticDimensions.generate(spark)
    flows.store_static(home, static)
    post = {
        "slug": "s", "author": {"name": " ann "}, "rawContent": "x",
        "publishedAt": "2024-02-29T10:00:00.000Z", "updatedAt": None,
        "totalUniqueImpressions": None, "numComments": 2,
        "reactions": [{"reaction": "🔥", "users": ["bob", " "], "count": 5},
                      {"reaction": "🚀", "users": [], "count": 9},
                      {"reaction": "odd", "users": ["cat"], "count": 1}],
        "mentions": [{"name": None}, {"name": "m"}], "attachments": [{"type": "image"}],
    }
    for moment, content in ((FIRST, "x"), (SECOND, "y")):
        batch = project_posts(raw(spark, [post, post | {"rawContent": content}], RAW_POST, moment))
        load = flows.posts_load(
            batch, home.live("dds.parties"), home.live("dds.dim_posts"), static, moment, ["position"]
        )
        flows.commit(home, load)
    contents = {(r.content_raw, r.is_current) for r in home.frame("dds.dim_posts").collect()}
    assert contents == {("x", False), ("y", True)}
    assert [r.num_reactions for r in home.frame("dds.fact_posts_metrics").collect()] == [6, 6]
    assert home.frame("dds.fact_posts_reactions").count() == 2

    paper = {
        "id": "2401.00001", "authors": None, "published_at": None, "title": "t", "summary": "s",
        "upvotes": 1, "comments": 0, "submitted_at": "2024-02-01T00:00:00Z",
        "submitted_by": {"username": "lab"}, "ai_keywords": ["k1"], "organization": {"name": "lab"},
    }
    for moment, words in ((FIRST, ["k1"]), (SECOND, ["k1", "k2"])):
        batch = project_papers(
            raw(spark, [paper | {"ai_keywords": words}, paper | {"id": "late", "submitted_at": ""}],
                RAW_PAPER, moment)
        )
        load = flows.papers_load(batch, home.live("dds.parties"), static, moment, ["position"])
        assert [(r.key, r.reason) for r in load.rejects.collect()] == [("late", "no_submitted_date")]
        flows.commit(home, load)
    assert home.frame("dds.dim_papers").count() == 1
    assert home.frame("dds.bridge_papers_keywords").count() == 2
    assert [r.type for r in home.live("dds.parties").where("name = 'lab'").collect()] == ["org"]


def test_replaced_mart(spark, home):
    df = spark.createDataFrame([("mit", 3)], "license string, models_count long")
    home.replace_mart(df, "license_histogram", FIRST)
    home.replace_mart(df.limit(0).unionByName(df.withColumn("models_count", F.lit(4))),
                      "license_histogram", SECOND)
    assert [r.models_count for r in home.frame("ads.license_histogram").collect()] == [4]


def test_staged_files(spark, tmp_path):
    df = spark.createDataFrame([("a", FIRST), ("b", None)], "id string, at timestamp")
    path = staging.write_staged_json(df, str(tmp_path), "models", "raw", "20240301T000000")
    back = staging.decode_datetimes(
        staging.scan_staged_json(spark, path, "id string, at string"), ["at"]
    )
    good, bad = staging.split_corrupt(back)
    assert sorted(map(tuple, good.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)

    array = tmp_path / "array.json"
    array.write_text('[{"id": "x"},\n {"id": "y"}]')
    rows = staging.scan_staged_json(spark, str(array), "id string", array_files=True)
    assert [r.id for r in rows.collect()] == ["x", "y"]

    broken = tmp_path / "broken.json"
    broken.write_text('{"id": "x"}\n\n{"id": \n')
    good, bad = staging.split_corrupt(staging.scan_staged_json(spark, str(broken), "id string").cache())
    assert (good.count(), bad.count()) == (1, 1)


def test_batches(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    path = str(tmp_path / "t")
    for moment in (FIRST, SECOND, SECOND):
        tables.append_batch(df, path, moment)
    stored = spark.read.schema("n int, loaded_at timestamp").parquet(path)
    assert stored.count() == 2
    assert tables.batch_scan(stored, "2024-03-02 05:00:00.000000", ["n"]).count() == 1
    assert tables.batch_scan(stored, None).count() == 0
    with pytest.raises(ValueError):
        tables.batch_scan(stored, "2024-03-02")


FANNED = "id string, authors array<string>, published_at timestamp, upvotes int, position long"


def paper_rows(spark, rows):
    """Rows of papers; declared columns that are not given are null."""
    df = spark.createDataFrame(rows, FANNED)
    given = set(df.columns) | {"loaded_at"}
    absent = [f for f in table("ods.papers").schema if f.name not in given]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])


def test_fan_out_forms_hold_the_load(spark, tmp_path):
    """The forms equal what is derived from the load itself; a rerun replaces one load only."""
    old = dt.datetime(1850, 5, 5, 10, 0, 0, 123456)
    first = paper_rows(spark, [("gone", ["x"], None, 1, 0)])
    load = paper_rows(spark, [
        ("p", ["a", None], old, 3, 1), ("p", ["a", None], old, 3, 1), ("q", None, None, None, None),
        (None, [], dt.datetime(2024, 1, 1), 0, 2),
    ])
    for df, moment in ((load, SECOND), (first, FIRST), (load, FIRST)):
        paths = tables.fan_out(df, "papers", str(tmp_path), moment)
    spec = table("ods.papers")
    stamped = tables.with_batch(load, FIRST)
    wanted = {
        "rows": tables.nullable_rows(stamped, spec),
        "documents": tables.document_rows(stamped),
        "columnar": tables.normalised_rows(stamped, spec),
    }
    assert list(paths) == list(wanted)
    for form, rows in wanted.items():
        stored = spark.read.schema(rows.schema).parquet(paths[form])
        for moment in (FIRST, SECOND):
            got = tables.batch_scan(stored, moment).drop("loaded_at").collect()
            assert sorted(map(str, got)) == sorted(map(str, rows.drop("loaded_at").collect())), form
        assert stored.count() == 8


def test_fan_out_computes_a_load_once_and_caches_nothing(spark, tmp_path, monkeypatch):
    load = paper_rows(spark, [("p", ["a"], None, 3, 1), ("q", None, None, None, 2)])

    def refuse(*_):
        raise AssertionError("a load of any size does not fit the memory of the executors")

    for name in ("persist", "cache"):
        monkeypatch.setattr(type(load), name, refuse)
    paths = tables.fan_out(load.withColumn("title", F.expr("uuid()")), "papers", str(tmp_path), FIRST)
    title = {"rows": "title", "documents": "document.title", "columnar": "title"}
    read = {form: spark.read.parquet(path) for form, path in paths.items()}
    drawn = [sorted(r[0] for r in df.select(title[form]).collect()) for form, df in read.items()]
    assert len(set(drawn[0])) == 2 and drawn[0] == drawn[1] == drawn[2]
    # Three copies of a load are stored, so they are compressed well.
    assert all(".zstd." in f for df in read.values() for f in df.inputFiles())


def test_fan_out_checks_the_columns_before_it_writes(spark, tmp_path):
    with pytest.raises(Exception, match="authors"):
        tables.fan_out(paper_rows(spark, []).drop("authors"), "papers", str(tmp_path), FIRST)
    assert not list(tmp_path.iterdir())


def test_fan_out_of_no_rows_changes_nothing(spark, tmp_path):
    load = paper_rows(spark, [("p", ["a"], None, 3, 1)])
    for df, stored in ((load.limit(0), 0), (load, 1), (load.limit(0), 1)):
        for path in tables.fan_out(df, "papers", str(tmp_path), FIRST).values():
            assert spark.read.schema("loaded_at timestamp").parquet(path).count() == stored


def test_gate(spark):
    names = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    some = spark.createDataFrame([("a",)], "name string")
    quality.gate(quality.coverage(quality.compare_names({"d": names}, {"d": names.distinct()})))
    with pytest.raises(quality.CoverageError, match="d: 1 missing, e.g. b"):
        quality.gate(quality.coverage(quality.compare_names({"d": names}, {"d": some})))


def test_day_partials_follow_the_ledger(spark, home, tmp_path):
    """An update computes the days of ended loads only, and the marts equal a full computation."""
    flows.store_static(home, flows.StaticDimensions.generate(spark))
    store = days.DayStore(spark, str(tmp_path / "days"))
    assert store.update(home) == []
    load_models(spark, home, MODELS[0], FIRST)
    assert store.update(home) == [20240301]
    assert store.update(home) == []
    before = sorted(map(str, store.read().models.where("date_id = 20240301").collect()))
    of_first = lambda: {f for f in store.read().models.inputFiles() if "date_id=20240301" in f}
    files = of_first()
    load_models(spark, home, MODELS[1], SECOND)
    assert store.update(home) == [20240302]
    assert sorted(map(str, store.read().models.where("date_id = 20240301").collect())) == before
    assert files and of_first() == files

    # A later hour of a known day: that day is computed anew with both snapshots.
    later = SECOND + dt.timedelta(hours=3)
    load_models(spark, home, [model("org/a", downloads=9, trending_score=4.25)], later)
    assert store.update(home) == [20240302]
    frames = [home.frame(f"dds.{n}") for n in ("dim_models", "parties", "fact_models_metrics", "dim_date")]
    whole, merged = marts.DetailTables(*frames), marts.DetailTables(*frames, store.read())
    as_of = SECOND.date()
    seen = lambda df: sorted(map(str, df.collect()))
    for t in (whole, merged):
        assert [r.models_count for r in marts.trending_line(t, as_of).orderBy("trend_date").collect()] == [3, 4]
    for build in (
        lambda t: marts.unique_recent(t, as_of),
        lambda t: marts.trending_line(t, as_of, distinct_models=True),
        lambda t: marts.leaderboard(t, as_of),
        lambda t: marts.owners_treemap(t, marts.unique_recent(t, as_of)),
        lambda t: marts.owners_treemap(t, marts.unique_recent(t, as_of), snapshot="latest"),
    ):
        assert seen(build(merged)) == seen(build(whole))


def test_a_day_that_lost_its_rows(spark, tmp_path):
    store = days.DayStore(spark, str(tmp_path))
    ddl = "model_id string, downloads long, likes long, trending_score double, date_id int, time_id int"
    rows = [("a", 1, 1, 1.0, 20240301, 1), ("a", 2, 1, None, 20240302, 1), ("a", None, 1, float(3), 20240302, 2)]
    store.replace_days(spark.createDataFrame(rows, ddl), [20240301, 20240302])
    assert [(r.date_id, r.downloads, r.scored, r.last.time_id) for r in store.read().models.orderBy("date_id").collect()] == [
        (20240301, 1, 1, 1), (20240302, 2, 1, 2)]
    store.replace_days(spark.createDataFrame([], ddl), [20240302])
    assert [r.date_id for r in store.read().lines.collect()] == [20240301]
    assert [r.date_id for r in store.read().models.collect()] == [20240301]


def test_audit_log_follows_the_ledger(spark, home, tmp_path):
    """After each load only its days are audited; the report is that of a full audit."""
    flows.store_static(home, flows.StaticDimensions.generate(spark))
    name = "dds.fact_models_metrics"
    log = audit_log.AuditLog(home, name, str(tmp_path / "audit"))
    assert log.update() == [] and log.report().agg(F.sum("violations")).first()[0] == 0
    shown = lambda df: sorted(map(str, df.collect()))
    for records, moment in zip(MODELS, (FIRST, SECOND)):
        load_models(spark, home, records, moment)
        if moment == SECOND:
            # Faults that only an audit sees: a reference to nothing and a repeated key.
            bad = [("nobody", 1, 1, 0.5, 20240302, 5)] * 2
            home.append(spark.createDataFrame(bad, table(name).columns), name)
        assert log.update() == [int(moment.strftime("%Y%m%d"))]
        assert log.update() == []
        targets = {n: home.frame(n) for n in TABLES if n.startswith("dds.")}
        assert shown(log.report()) == shown(quality.audit(home.frame(name), table(name), targets))
    assert {(r.rule, r.violations) for r in log.report().where("violations > 0").collect()} == {("key", 1), ("reference", 2)}
