"""Benchmark decontamination by MinHash containment search, exactly verified.

An item of n distinct word shingles is contained in a document that holds at least
ceil(t n) of them.  Items are partitioned by size: from n follows how many shingles a
document may lack, n - ceil(t n), and the item's MinHash sketch is its smallest hashes,
one more than that.  A document that contains the item shares at least one hash with the
sketch, however long it is, so the search misses nothing; documents with fewer shingles
than the item needs are passed over by size.  Every candidate is then verified by counting
the item's shingles in the document as exact strings.

All of it is built-in functions.  The sketches are broadcast in blocks of a bounded size.
The search carries keys and hashes, no texts, so its cost is linear in a text's length;
texts are read again for their candidates only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored

APART = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Settings:
    """``broadcast``: characters of sketches (item texts times hashes) in one block."""

    words: int = 5
    share: float = 0.8
    broadcast: int = 16_000_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), APART), "")


def shingle_hashes(words: Column, width: int) -> Column:
    """A hash per shingle; a shorter text is one shingle, no word none."""
    n = F.size(words)
    run = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(width)))
    return (
        F.when(n >= width, F.transform(F.sequence(F.lit(0), n - width), run))
        .when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", words))))
        .otherwise(F.array().cast("array<long>"))
    )


def shingles(words: Column, width: int) -> Column:
    """The same shingles as strings."""
    n = F.size(words)
    run = lambda i: F.concat_ws(" ", F.slice(words, i, width))
    return (
        F.when(n >= width, F.transform(F.sequence(F.lit(1), n - width + 1), run))
        .when(n > 0, F.array(F.concat_ws(" ", words)))
        .otherwise(F.array().cast("array<string>"))
    )


def sketches(benchmark: DataFrame, settings: Settings) -> DataFrame:
    """One row per item and sketch hash: ``hash, item_id, n, least, parts, short``."""
    known = benchmark.select("item_id", words_of(F.col("text")).alias("words")).distinct()
    sized = known.select(
        "item_id",
        (F.size("words") < settings.words).alias("short"),
        F.array_distinct(shingles(F.col("words"), settings.words)).alias("parts"),
        F.array_distinct(shingle_hashes(F.col("words"), settings.words)).alias("hashes"),
    ).where(F.size("parts") > 0)
    least = F.ceil(F.size("parts") * settings.share - 1e-9)
    lacking = F.size("parts") - least
    return sized.select(
        "item_id", "short", "parts", F.size("parts").alias("n"), least.cast("int").alias("least"),
        F.explode(F.slice(F.array_sort("hashes"), 1, (lacking + 1).cast("int"))).alias("hash"),
    )


def contained(docs: DataFrame, key: str, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(key, item_id, shared, item_shingles)`` of every contained item.

    ``docs`` needs the columns ``key`` and text.  Rows of one key count as one document
    each; the largest count is returned.  An item or document without words takes no
    part; one of fewer words than a shingle is one shingle, its whole sequence.  Repeated
    items are one item; a NULL item_id or key is returned as NULL.
    """
    table = stored(sketches(benchmark, settings), "sketches")
    size = table.agg(F.sum(F.aggregate("parts", F.lit(0), lambda a, x: a + F.length(x)))).first()[0] or 0
    blocks = max(1, -(-size // settings.broadcast))
    texts = docs.select(F.col(key).alias("doc_key"), F.xxhash64("text").alias("tag"), "text")
    near = None
    for b in range(blocks):
        part = table.where(F.pmod(F.xxhash64("parts"), F.lit(blocks)) == b)
        some = _candidates(texts, part, settings)
        near = some if near is None else near.unionAll(some)
    return _verified(texts, stored(near, "contained-candidates")).groupBy(F.col("doc_key").alias(key), "item_id", "item_shingles").agg(
        F.max("shared").alias("shared")
    )


def _candidates(texts: DataFrame, part: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of texts, by key and tag, and items of one block that share a sketch hash."""
    words = words_of(F.col("text"))
    # Exploded, the words are a value of the row; otherwise each shingle would split the text anew.
    split = texts.select("doc_key", "tag", F.explode(F.array(words)).alias("words"))
    sized = split.select("doc_key", "tag", F.size("words").alias("size"), "words")
    hashed = sized.select(
        "doc_key", "tag", "size", F.explode(shingle_hashes(F.col("words"), settings.words)).alias("doc_hash")
    )
    room = F.greatest(F.col("size") - (settings.words - 1), F.lit(1))
    near = hashed.join(
        F.broadcast(part),
        (F.col("doc_hash") == F.col("hash"))
        & (room >= F.col("least"))
        & ((F.col("size") < settings.words) == F.col("short")),
    )
    return near.select(
        F.col("doc_key").alias("near_key"), F.col("tag").alias("near_tag"), "item_id", "n", "least", "parts"
    ).distinct()


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Candidates whose item is contained, counted as strings in the text they were found in."""
    words = words_of(F.col("text"))
    line = F.concat(F.lit(" "), F.concat_ws(" ", words), F.lit(" "))
    held = F.filter("parts", lambda s: F.contains(F.col("line"), F.concat(F.lit(" "), s, F.lit(" "))))
    own = F.col("doc_key").eqNullSafe(F.col("near_key")) & (F.col("tag") == F.col("near_tag"))
    # Only eight bytes of each suspect are compared with all texts, so that the optimizer may
    # broadcast them; a text is prepared once, before it meets its candidates.
    few = pairs.select("near_tag").distinct()
    suspects = texts.join(few, F.col("tag") == F.col("near_tag"), "left_semi").dropDuplicates(["doc_key", "tag"])
    lines = suspects.select("doc_key", "tag", line.alias("line"))
    return (
        lines.join(pairs, own)
        .select("doc_key", "item_id", F.col("n").alias("item_shingles"), "least", F.size(held).alias("shared"))
        .where("shared >= least")
        .select("doc_key", "item_id", "item_shingles", "shared")
    )


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns.

    Whether a row goes depends on its text alone, so rows without doc_id are judged like
    any other.
    """
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    hits = contained(docs.select(digest.alias("digest"), "text"), "digest", benchmark, settings)
    bad_digest = free_name(docs, "bad_digest")
    bad = stored(hits.select(F.col("digest").alias(bad_digest)).distinct(), "contaminated")
    return docs.join(bad, digest == F.col(bad_digest), "left_anti")


_SQL_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_SQL_WORDS} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, len(w) < 5 AS short, unnest(CASE WHEN len(w) >= 5
         THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
bs AS (SELECT DISTINCT item_id, w, len(w) < 5 AS short, unnest(CASE WHEN len(w) >= 5
         THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM b),
n AS (SELECT item_id, w, count(*) AS n FROM bs GROUP BY ALL)
SELECT doc_id, bs.item_id, cast(n AS integer) AS item_shingles, cast(count(*) AS integer) AS shared,
       count(*) / n AS containment
FROM ds JOIN bs USING (s, short) JOIN n ON n.item_id = bs.item_id AND n.w = bs.w
GROUP BY doc_id, bs.item_id, bs.w, n HAVING count(*) >= ceil(0.8 * n - 1e-9)
"""
