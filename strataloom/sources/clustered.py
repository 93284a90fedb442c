"""Tables laid out for what reads them: bucketed for joins, sorted for point look-ups."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import fresh_dir
from .tables import with_batch

# Bytes of a row group and rows of a page of a sorted table: what a look-up reads at least.
ROW_GROUP, PAGE_ROWS = 8 << 20, 2000


def clustered(df: DataFrame, key: str, buckets: int, label: str) -> DataFrame:
    """``df`` as a catalogue table bucketed and sorted by ``key``.

    Tables with the same number of buckets and the same type of key are joined, and
    grouped by the key, without an exchange.  A bucket is read by one task, so the key
    should have a bounded number of rows: a fact table has one row per entity and hour.
    """
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex[:12]}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key).sortBy(key)
        .option("path", fresh_dir(spark, label))
        .saveAsTable(name)
    )
    return spark.table(name)


def append_sorted(
    df: DataFrame,
    path: str,
    loaded_at: str | dt.datetime,
    sort_by: Sequence[str],
    row_group: int = ROW_GROUP,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Add one load to a table partitioned by load and sorted by ``sort_by``.

    Rows are dealt by ranges of the sort columns, so files cover separate ranges, and row
    groups and pages inside a file do too; a look-up by the first of them skips by the
    statistics of each.  A rerun of the load replaces its rows.  ``row_group`` and
    ``page_rows`` bound what a look-up of one value reads.
    """
    ordered = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    (
        with_batch(ordered, loaded_at)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", row_group)
        .option("parquet.page.row.count.limit", page_rows)
        .partitionBy("loaded_at")
        .parquet(path)
    )
