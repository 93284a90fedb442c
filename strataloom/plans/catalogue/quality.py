"""Coverage and constraint audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.text import strip_to_null
from ...operators import audits, parties, quality
from ...operators.flatten import unnest
from ...operators.dimensions import dim_time
from ...operators.latest import partition_values
from ...schemas import Table, table
from ..given import Given
from ..registry import query
from .joins import post_versions


def raw_names(g: Given) -> DataFrame:
    """Every mention of a dictionary name in the raw layer, one pass over each feed."""

    def named(dictionary: str, names: Column) -> Column:
        clean = strip_to_null if dictionary == "parties" else (lambda name: name)
        return F.transform(
            F.coalesce(names, F.array().cast("array<string>")),
            lambda n: F.struct(F.lit(dictionary).alias("dictionary"), clean(n).alias("name")),
        )

    nobody = F.array().cast("array<string>")
    users = F.flatten(F.transform("reactions", lambda r: F.coalesce(r["users"], nobody)))
    feeds = (
        (g.models, named("parties", F.array("owner")), named("datasets", F.col("dataset"))),
        (g.papers, named("parties", F.array("submitted_by", "organization")),
         named("authors", F.col("authors")), named("keywords", F.col("ai_keywords"))),
        (g.posts, named("parties", F.array("author")), named("parties", users)),
    )
    parts = [feed.select(F.inline(F.concat(*names))) for feed, *names in feeds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def dictionaries(g: Given) -> dict[str, DataFrame]:
    """Dictionaries with holes: each knows what one given table holds."""
    prefixed = {
        "datasets": g.table("part").selectExpr("concat('ds', p_size) AS name"),
        "authors": g.table("supplier").selectExpr("concat('author', s_suppkey) AS name"),
        "keywords": g.table("conversations").select(F.explode(F.split("text", " ")).alias("name")),
    }
    owners = g.known_users.unionByName(g.table("events").selectExpr("concat('member', user_id) AS name"))
    return {"parties": owners.distinct()} | {k: d.distinct() for k, d in prefixed.items()}


_RAW_SQL = {
    "raw_names": """
        SELECT 'parties' AS dictionary, name FROM (
          SELECT owner AS name FROM ods_models
          UNION ALL SELECT submitted_by FROM ods_papers
          UNION ALL SELECT organization FROM ods_papers
          UNION ALL SELECT nullif(trim(author), '') FROM ods_posts
          UNION ALL SELECT nullif(trim(unnest(r.users)), '')
            FROM (SELECT unnest(reactions) AS r FROM ods_posts)) WHERE name IS NOT NULL
        UNION ALL SELECT 'datasets', unnest(dataset) FROM ods_models
        UNION ALL SELECT 'authors', unnest(authors) FROM ods_papers
        UNION ALL SELECT 'keywords', unnest(ai_keywords) FROM ods_papers""",
    "dds_names": """
        SELECT DISTINCT 'parties' AS dictionary, name FROM (
          SELECT name FROM known_users UNION ALL SELECT 'member' || user_id FROM events)
        UNION ALL SELECT DISTINCT 'datasets', 'ds' || p_size FROM part
        UNION ALL SELECT DISTINCT 'authors', 'author' || s_suppkey FROM supplier
        UNION ALL SELECT DISTINCT 'keywords', unnest(string_split(text, ' ')) FROM conversations""",
    "missing": """
        SELECT DISTINCT dictionary, name FROM raw_names
        WHERE (dictionary, name) NOT IN (SELECT (dictionary, name) FROM dds_names)""",
    "totals": """
        SELECT dictionary, count(*) AS ods_total_count, count(DISTINCT name) AS ods_unique_count,
          (SELECT count(*) FROM dds_names d WHERE d.dictionary = r.dictionary) AS dds_unique_count,
          (SELECT count(*) FROM missing m WHERE m.dictionary = r.dictionary) AS missing_count
        FROM raw_names r GROUP BY 1""",
}
_COVERAGE_SQL = """
    SELECT t.*, (SELECT array_to_string(list_slice(list_sort(list(name)), 1, 10), ',')
      FROM missing m WHERE m.dictionary = t.dictionary) AS missing_sample
    FROM totals t"""


@query(_COVERAGE_SQL, _RAW_SQL)
def dq_coverage(g: Given) -> DataFrame:
    """All four dictionaries at once."""
    return _coverage(g, raw_names(g), dictionaries(g))


def _coverage(g: Given, raw: DataFrame | dict[str, DataFrame], known: dict[str, DataFrame]) -> DataFrame:
    return quality.coverage(g.stored(quality.compare_names(raw, known), "compared-names"))


def _one(g: Given, name: str, raw: DataFrame) -> DataFrame:
    return _coverage(g, {name: raw}, {name: dictionaries(g)[name]})


def _one_sql(name: str) -> str:
    return f"SELECT * FROM ({_COVERAGE_SQL}) WHERE dictionary = '{name}'"


@query(_one_sql("parties"), _RAW_SQL)
def dq_coverage_parties(g: Given) -> DataFrame:
    names = parties.all_party_names(g.models, g.papers, g.posts)
    return _one(g, "parties", names)


@query(_one_sql("datasets"), _RAW_SQL)
def dq_coverage_datasets(g: Given) -> DataFrame:
    names = unnest(g.models, "dataset", "name")
    return _one(g, "datasets", names)


@query(_one_sql("authors"), _RAW_SQL)
def dq_coverage_authors(g: Given) -> DataFrame:
    names = unnest(g.papers, "authors", "name")
    return _one(g, "authors", names)


@query(_one_sql("keywords"), _RAW_SQL)
def dq_coverage_keywords(g: Given) -> DataFrame:
    names = unnest(g.papers, "ai_keywords", "name")
    return _one(g, "keywords", names)


@query(
    """
    SELECT dictionary, ods_total_count, ods_unique_count, dds_unique_count,
      CASE WHEN missing_count = 0 THEN '✓' ELSE '✗' END AS coverage FROM totals""",
    _RAW_SQL,
)
def dq_report(g: Given) -> DataFrame:
    return quality.report(_coverage(g, raw_names(g), dictionaries(g)))


@query("SELECT 'datasets' AS dictionary, count(DISTINCT d) AS names FROM (SELECT unnest(dataset) AS d FROM ods_models)")
def dq_gate(g: Given) -> DataFrame:
    """Passes a dictionary built from the raw layer and stops at one with holes.

    The raw layer is read once: both dictionaries are made of its counted names.
    """
    raw = g.stored(quality.mentions({"datasets": unnest(g.models, "dataset", "name")}), "mentions")
    names = raw.select("name").distinct()
    full = _coverage(g, raw, {"datasets": names})
    quality.gate(full)
    holes = names.where("name <> 'ds1'")
    try:
        quality.gate(_coverage(g, raw, {"datasets": holes}))
    except quality.CoverageError:
        return full.select("dictionary", F.col("dds_unique_count").alias("names"))
    raise AssertionError("the gate let a gap pass")


_ORDERS = Table(
    "given.orders",
    "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string",
    key=("o_orderkey",),
    unique=("o_custkey",),
    refs={"o_custkey": "given.nation"},
    required=("o_orderkey", "o_orderstatus"),
    max_length={"o_orderpriority": 6},
)


@query("""
    SELECT 'given.orders' AS table_name, 'not_null' AS rule, 'o_orderkey' AS column_name,
      count(*) FILTER (o_orderkey IS NULL) AS violations FROM orders
    UNION ALL SELECT 'given.orders', 'not_null', 'o_orderstatus',
      count(*) FILTER (o_orderstatus IS NULL) FROM orders
    UNION ALL SELECT 'given.orders', 'length', 'o_orderpriority',
      count(*) FILTER (length(o_orderpriority) > 6) FROM orders
    UNION ALL SELECT 'given.orders', 'key', 'o_orderkey', count(*) FROM (
      SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'given.orders', 'unique', 'o_custkey', count(*) FROM (
      SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'given.orders', 'reference', 'o_custkey', count(*) FROM orders
      WHERE o_custkey NOT IN (SELECT n_nationkey FROM nation)""")
def dq_constraints(g: Given) -> DataFrame:
    """Key, unique, reference, not-null and length rules of a table that breaks some."""
    nations = g.table("nation").select(F.col("n_nationkey").cast("long").alias("id"))
    return quality.audit(g.table("orders"), _ORDERS, {"given.nation": nations})


_FACTS = table("dds.fact_models_metrics")


@query(
    " UNION ALL ".join(
        [
            f"SELECT '{_FACTS.name}' AS table_name, 'not_null' AS rule, '{c}' AS column_name, "
            f"count(*) FILTER ({c} IS NULL) AS violations FROM dds_metrics"
            for c in _FACTS.required
        ]
        + [
            f"""SELECT '{_FACTS.name}', 'key', 'model_id,date_id,time_id', count(*) FROM (
              SELECT 1 FROM dds_metrics GROUP BY model_id, date_id, time_id HAVING count(*) > 1)""",
            f"""SELECT '{_FACTS.name}', 'reference', 'model_id', count(*) FROM dds_metrics
              WHERE model_id NOT IN (SELECT p_partkey FROM part WHERE p_size < 45)""",
            f"""SELECT '{_FACTS.name}', 'reference', 'date_id', count(*) FROM dds_metrics
              WHERE day NOT BETWEEN DATE '2000-01-01' AND DATE '2030-12-31'""",
            f"SELECT '{_FACTS.name}', 'reference', 'time_id', count(*) FROM dds_metrics WHERE time_id NOT BETWEEN 0 AND 23",
        ]
    )
)
def dq_load_audit(g: Given) -> DataFrame:
    """The audit of all facts after three loads, each of which was audited alone.

    A load brings further hours of its days and further models; some keys repeat and some
    models never come, so rules are broken, and references broken at first are cured.
    """
    metrics, models = g.detail.metrics, g.table("part")
    none = g.spark.createDataFrame([], audits.COUNTS), g.spark.createDataFrame([], audits.ORPHANS)
    state, before, targets = audits.PartAudit(*none), 0, {}
    for until, sizes in ((2, 20), (5, 35), (24, 45)):
        targets = {
            "dds.dim_models": models.where(F.col("p_size") < sizes).select(F.col("p_partkey").alias("id")),
            "dds.dim_date": g.dates, "dds.dim_time": dim_time(g.spark),
        }
        loaded = (F.col("time_id") > before) & (F.col("time_id") <= until)
        days = partition_values(metrics.where(loaded), "date_id")
        touched = metrics.where((F.col("time_id") <= until) & F.col("date_id").isin(*days))
        after = audits.carried(state, audits.audit_parts(touched, _FACTS, targets, "date_id"), days)
        state = audits.PartAudit(g.stored(after.counts, "audit-counts"), g.stored(after.orphans, "audit-orphans"))
        before = until
    return audits.totals(state, _FACTS, targets)


@query("SELECT 'posts' AS table_name, 0::BIGINT AS conflicts, count(DISTINCT slug) AS keys FROM ods_posts")
def dq_one_current(g: Given) -> DataFrame:
    """No key of a versioned dimension has two live versions."""
    built = post_versions(g)
    conflicts = quality.current_conflicts(built, "slug").agg(F.count(F.lit(1)).alias("conflicts"))
    keys = built.agg(F.count_distinct("slug").alias("keys"))
    return keys.select(
        F.lit("posts").alias("table_name"), conflicts.scalar().alias("conflicts"), "keys"
    )


@query("SELECT 'documents' AS label, count(*) AS rows FROM documents")
def dq_volume(g: Given) -> DataFrame:
    """Rows counted by the job that uses them, here one that finds distinct sources."""
    observed, seen = quality.with_volume(g.table("documents"), "documents")
    observed.select("source").distinct().write.format("noop").mode("overwrite").save()
    rows = seen.get["rows"]
    return g.spark.range(1).select(
        F.lit("documents").alias("label"), F.lit(rows).cast("long").alias("rows")
    )
