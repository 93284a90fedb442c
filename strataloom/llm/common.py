"""What several operators share: folds, bounded samples, written tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir

_GRAIN = 1 << 24


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it lies.

    For sessions started without the package on their path; a cluster that got it with
    ``--py-files`` or by installation finds that first.
    """
    here = os.path.abspath(__file__)
    root = os.path.dirname(os.path.dirname(os.path.dirname(here)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            [p for p in paths if p] + [root]
        )
    return spark


def fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Later jobs start from the files, so a lost executor costs one task again and
    not the steps before the table.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sampled(df: DataFrame, key: Column, share: Column | float) -> DataFrame:
    """Rows whose hashed key falls below ``share`` (0 to 1) of the hash range.

    A row-wise filter: no shuffle, the same rows on every run.
    """
    share = share if isinstance(share, Column) else F.lit(float(share))
    draw = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(_GRAIN))
    return df.where(draw < F.ceil(share * _GRAIN))


def share_of(bound: int, rows: int) -> float:
    """The share that takes ``bound`` of ``rows`` on average."""
    return min(1.0, bound / rows) if rows else 1.0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, bound: int
) -> DataFrame:
    """Texts of about ``bound`` labelled documents outside the held-out fold.

    Returns ``(text, label)``, label 0 or 1.  Of several label rows of one document
    the majority counts, ties as 1; of several rows of one document the first text in
    order is taken, so a repeated row weighs no more than another.  The sample is drawn
    from the labels: at most about ``bound`` ids of 12 bytes are broadcast, and only the
    texts drawn are shuffled.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(fold("doc_id", folds) != 0)
        .groupBy("doc_id")
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
    )
    rows = known.count()
    ids = sampled(known, F.col("doc_id"), share_of(bound, rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    drawn = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return stored(drawn.select("text", "label"), "labelled")


def sigmoid(x):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def as_batch(rows: list[tuple], schema):
    """An Arrow record batch of Python tuples."""
    import pyarrow as pa

    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
