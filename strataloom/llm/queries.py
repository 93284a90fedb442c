"""The operators as queries over the given tables, with their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, ann, decontaminate, langid, mending, packing, preference, quality, repeats, simhash, tokenstore,
    toxicity, urls,
)
from .common import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "benchmark")
    )
    return found.withColumn("containment", F.col("shared") / F.col("item_shingles"))


ORACLE_SQL["op2_decontamination"] = decontaminate.SQL


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(packing.pack(table(spark, sf_dir, "documents")))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = tokenstore.round_trip(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors.where("vec_id % 20 = 0"), vectors, 20)


@query
def op9_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return preference.preference_pairs(turns, preference.swapped_answers(turns), "conv_id")


ORACLE_SQL["op9_preference_pairs"] = preference.SQL

URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), with_groups=False).drop("groups")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mending.repair_damaged(table(spark, sf_dir, "conversations"))


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


ORACLE_SQL["op13_substring_dedup"] = repeats.SQL
