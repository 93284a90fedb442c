"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps; every stage but the
last returns the columns of documents.  Written out as Parquet, the result of a stage is
the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataloom.llm import decontaminate, langid, packing, quality, simhash
from strataloom.llm.common import importable, stored

LEAST_QUALITY = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from docs itself."""
    importable(spark)
    return langid.in_known_language(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled rows of docs, scores well.

    Whether a row stays depends on its text alone, NULL being empty; repeated rows share
    their fate, and an empty table stays empty.
    """
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = quality.learned_scorer(docs, labels)
    return docs.where(score("text") >= LEAST_QUALITY)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id.

    Groups are those of the SimHash operator: fingerprints of three-word shingles, linked
    at two or fewer differing bits.  Rows without doc_id and the texts of a repeated
    doc_id are treated as in ``simhash.one_of_each``.
    """
    importable(spark)
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    importable(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, as in the packing query.

    A NULL text is its end id alone; repeated rows and rows without doc_id are packed like
    any other; an empty table gives no piece.
    """
    importable(spark)
    return packing.pieces(packing.pack(docs))


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# Learned models and tokenizers are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
