"""Landing zone: staged JSON batches and their timestamps."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.moments import iso_text, parse_iso

CORRUPT = "_corrupt_record"

# Lines of a staged file at most.
FILE_ROWS = 50_000


def batch_path(root: str, entity: str, stage: str, batch: str) -> str:
    return f"{root}/entity={entity}/stage={stage}/batch_ts={batch}"


def write_staged_json(df: DataFrame, root: str, entity: str, stage: str, batch: str) -> str:
    """Stage one batch as JSON lines, timestamps as ISO text; replaces a rerun's files.

    Lines repeat every field name, so files are compressed.  Such a file is read by one
    task, so a task that stages much writes several of ``FILE_ROWS`` lines.
    """
    moments = {n: iso_text(F.col(n)) for n, kind in df.dtypes if kind == "timestamp"}
    path = batch_path(root, entity, stage, batch)
    (
        df.withColumns(moments)
        .write.mode("overwrite")
        .option("ignoreNullFields", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_ROWS)
        .json(path)
    )
    return path


def scan_staged_json(
    spark: SparkSession, paths: str | Sequence[str], ddl: str, array_files: bool = False
) -> DataFrame:
    """Read staged records with a declared schema.

    ``array_files`` reads files that hold one JSON array each; such a file cannot
    be split, so a feed of any size is staged as JSON lines.  Records that do not
    parse keep their text in ``_corrupt_record``.
    """
    return (
        spark.read.schema(f"{ddl}, {CORRUPT} string")
        .option("multiLine", array_files)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable records, rejects with their text)."""
    return (
        df.where(F.col(CORRUPT).isNull()).drop(CORRUPT),
        df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT),
    )


def decode_datetimes(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Turn the named ISO text columns back into timestamps; others stay."""
    present = {f: parse_iso(F.col(f)) for f in fields if f in df.columns}
    return df.withColumns(present)


def scan_json_lines(
    spark: SparkSession,
    path: str,
    ddl: str,
    datetime_fields: Sequence[str] = (),
    cap: int | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """JSON lines with blank lines skipped and the named fields decoded.

    A cap needs an order: lines of a split file have no position.
    """
    df = decode_datetimes(spark.read.schema(ddl).json(path), datetime_fields)
    if cap is None:
        return df
    if not order_by:
        raise ValueError("a capped scan needs order_by")
    return df.orderBy(*order_by).limit(cap)
