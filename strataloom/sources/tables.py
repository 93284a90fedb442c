"""Warehouse tables as catalogue tables over Parquet."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import or_empty
from ..operators.versions import BUCKET, VersionChange
from ..schemas import TABLES, Table, table
from ..session import fresh_dir

_BATCH_FORMAT = "%Y-%m-%d %H:%M:%S.%f"

# Files of a fan-out.  A load is stored three times, so they are compressed well; a row group
# is held whole by the task that writes or reads it, so it is small.
FORM_FILES: dict[str, str | int] = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": 5,
    "parquet.block.size": 32 << 20,
}


def batch_moment(loaded_at: str | dt.datetime) -> dt.datetime:
    """The batch identifier; text must be ``YYYY-MM-DD HH:MM:SS.ffffff`` in UTC."""
    if isinstance(loaded_at, str):
        loaded_at = dt.datetime.strptime(loaded_at, _BATCH_FORMAT)
    return loaded_at.replace(tzinfo=loaded_at.tzinfo or dt.timezone.utc)


def of_batch(loaded_at: str | dt.datetime) -> Column:
    return F.col("loaded_at") == F.lit(batch_moment(loaded_at))


def pick_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*columns) if columns else df


def batch_scan(
    df: DataFrame, loaded_at: str | dt.datetime | None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one load; a filter on the partition column, so other loads are not read.

    An empty extract has no batch and gives no rows.
    """
    chosen = df.where(of_batch(loaded_at)) if loaded_at else df.limit(0)
    return pick_columns(chosen, columns)


def with_batch(df: DataFrame, loaded_at: str | dt.datetime) -> DataFrame:
    return df.withColumn("loaded_at", F.lit(batch_moment(loaded_at)))


def nullable_rows(df: DataFrame, spec: Table) -> DataFrame:
    """Row form: declared columns by name, NULLs as they are."""
    return df.select(*spec.column_names)


def document_rows(df: DataFrame) -> DataFrame:
    """Document form: the nested record as one struct per row, keyed by batch."""
    body = [c for c in df.columns if c != "loaded_at"]
    return df.select(F.struct(*body).alias("document"), "loaded_at")


def normalised_rows(df: DataFrame, spec: Table) -> DataFrame:
    """Columnar form: numbers default to 0, lists to empty, reactions to JSON text."""
    out = []
    for field in spec.schema:
        column, kind = F.col(field.name), field.dataType.typeName()
        if field.name == "reactions":
            column = F.to_json(F.coalesce(column, F.array().cast(field.dataType)))
        elif kind == "array":
            column = or_empty(column)
        elif kind in ("integer", "long", "double"):
            column = F.coalesce(column, F.lit(0).cast(kind))
        out.append(column.alias(field.name))
    return df.select(*out)


def append_batch(
    df: DataFrame, path: str, loaded_at: str | dt.datetime, **options: str | int
) -> None:
    """Add one load to a partitioned table; a rerun of the load replaces its rows.

    ``options`` are those of the Parquet writer.
    """
    (
        with_batch(df, loaded_at)
        .write.mode("overwrite")
        .options(**options)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("loaded_at")
        .parquet(path)
    )


def fan_out(df: DataFrame, entity: str, root: str, loaded_at: str | dt.datetime) -> dict[str, str]:
    """Write one load in row, document and columnar form, computing it once.

    The document form has every column, so it is written first and the others are derived
    from its files.  Nothing of the load is cached, and a task holds one row group of what
    it reads and one of what it writes.
    """
    spec = table(f"ods.{entity}")
    shapes = {"rows": nullable_rows, "columnar": normalised_rows}
    load = with_batch(df, loaded_at)
    for shape in shapes.values():
        shape(load, spec)  # a load that lacks a column fails before anything is written
    documents = document_rows(load)
    paths = {form: f"{root}/{form}/{entity}" for form in ("rows", "documents", "columnar")}
    append_batch(documents.drop("loaded_at"), paths["documents"], loaded_at, **FORM_FILES)
    files = df.sparkSession.read.schema(documents.schema).parquet(paths["documents"])
    stored = batch_scan(files, loaded_at, ["document.*", "loaded_at"])
    for form, shape in shapes.items():
        append_batch(shape(stored, spec).drop("loaded_at"), paths[form], loaded_at, **FORM_FILES)
    return paths


def overwrite_mart(df: DataFrame, name: str, path: str, updated_at: dt.datetime) -> str:
    """Replace a mart, matching columns by name and stamping the refresh."""
    spec = table(f"ads.{name}")
    stamped = df.withColumn("updated_at", F.lit(batch_moment(updated_at)))
    stamped.select(*spec.column_names).write.mode("overwrite").parquet(path)
    return path


def _batch_folder(loaded_at: str | dt.datetime) -> str:
    return batch_moment(loaded_at).strftime("%Y%m%dT%H%M%S%f")


def _live(name: str) -> str:
    return f"{name}_live"


def _ended(name: str) -> str:
    return f"{name}_ended"


_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_mode_lock = threading.Lock()
_mode_users: dict[int, tuple[int, str | None]] = {}


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """The overwrite mode of a session, dynamic while any of its writers is inside."""
    with _mode_lock:
        users, before = _mode_users.get(id(spark), (0, spark.conf.get(_OVERWRITE_MODE, None)))
        _mode_users[id(spark)] = users + 1, before
        spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        with _mode_lock:
            users, before = _mode_users.pop(id(spark))
            if users > 1:
                _mode_users[id(spark)] = users - 1, before
            elif before is None:
                spark.conf.unset(_OVERWRITE_MODE)
            else:
                spark.conf.set(_OVERWRITE_MODE, before)


@dataclass(frozen=True)
class Warehouse:
    """The tables of all layers in the session catalogue, with files under ``root``.

    ``prefix`` goes before the database names.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    def frame(self, name: str) -> DataFrame:
        return self.spark.table(self.prefix + name)

    def refresh(self, name: str) -> None:
        """See what another session has stored in a table since it was last read."""
        physical = [_live(name), _ended(name)] if table(name).versioned else [name]
        for each in (*physical, name):
            self.spark.catalog.refreshTable(self.prefix + each)

    def live(self, name: str) -> DataFrame:
        """The live versions of a versioned dimension, with the bucket of their key."""
        spec = table(name)
        return self.frame(_live(name)).withColumn("is_current", F.lit(True)).select(
            *spec.column_names, BUCKET
        )

    def init_tables(self, layers: Iterable[str] = ("ods", "dds", "ads")) -> None:
        """Create the databases and empty tables of the layers; existing ones stay.

        A versioned dimension is a view over two tables: its live versions, stored by
        key bucket, and the ended ones, which only grow.  A load reads and rewrites the
        buckets of its keys, and a filter on ``is_current`` drops one side of the view.
        """
        wanted = set(layers)
        for layer in sorted(wanted):
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} "
                f"LOCATION '{self.root}/{layer}'"
            )
        for spec in TABLES.values():
            if spec.layer not in wanted:
                continue
            if spec.versioned:
                self._create_versioned(spec)
            else:
                self._create(spec.name, spec.columns, spec.partition_by)

    def _create(self, name: str, columns: str, partition_by: Sequence[str] = ()) -> None:
        partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.prefix}{name} ({columns}) USING parquet "
            f"{partitions} LOCATION '{self.root}/{name.replace('.', '/')}'"
        )

    def _create_versioned(self, spec: Table) -> None:
        stored = ", ".join(c for c in spec.columns.split(", ") if not c.startswith("is_current "))
        self._create(_live(spec.name), f"{stored}, {BUCKET} int", (BUCKET,))
        self._create(
            _ended(spec.name), f"{stored}, ended_by string, {BUCKET} int", ("ended_by", BUCKET)
        )
        sides = []
        for source, state in ((_live(spec.name), "true"), (_ended(spec.name), "false")):
            columns = ", ".join(
                f"{state} AS is_current" if c == "is_current" else c for c in spec.column_names
            )
            sides.append(f"SELECT {columns} FROM {self.prefix}{source}")
        self.spark.sql(
            f"CREATE VIEW IF NOT EXISTS {self.prefix}{spec.name} AS {' UNION ALL '.join(sides)}"
        )

    def drop(self, layers: Iterable[str]) -> None:
        """Remove the databases of a warehouse made for one trial, with all their tables."""
        for layer in layers:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{layer} CASCADE")

    def replace(self, df: DataFrame, name: str, loaded_at: str | dt.datetime) -> None:
        """Write a new state beside the old one, then point the catalogue at it.

        Readers keep the old files until the pointer moves, and a run that dies
        before that leaves the table as it was.
        """
        folder = f"{_batch_folder(loaded_at)}_{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{name.replace('.', '/')}__{folder}"
        df.select(*self.frame(name).columns).write.parquet(path)
        self.spark.sql(f"ALTER TABLE {self.prefix}{name} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.prefix + name)

    def replace_mart(self, df: DataFrame, name: str, updated_at: str | dt.datetime) -> None:
        stamped = df.withColumn("updated_at", F.lit(batch_moment(updated_at)))
        self.replace(stamped, f"ads.{name}", updated_at)

    def commit_versions(
        self, change: VersionChange, name: str, loaded_at: str | dt.datetime
    ) -> None:
        """Store what a load did to a versioned dimension, bucket by bucket.

        Ended versions go to partitions of their own load and bucket.  A run that died
        half-way is repeated whole: buckets that were replaced end nothing any more and
        keep what the first attempt has stored, the others are stored anew.
        """
        load = F.lit(_batch_folder(loaded_at))
        ended = change.closed.drop("is_current").withColumn("ended_by", load)
        self._overwrite_partitions(ended, _ended(name))
        self._overwrite_partitions(change.current.drop("is_current"), _live(name))

    def commit_partitions(self, df: DataFrame, name: str) -> None:
        """Replace the partitions ``df`` covers; it may be computed from the table.

        Spark does not overwrite what it reads, so the rows pass through a table
        in the shared scratch folder.
        """
        path = fresh_dir(self.spark, name.replace(".", "_"))
        df.select(*table(name).column_names).write.parquet(path)
        staged = self.spark.read.schema(table(name).columns).parquet(path)
        self._overwrite_partitions(staged, name)

    def _overwrite_partitions(self, df: DataFrame, name: str) -> None:
        # An insert takes the mode from the session only; without it the insert
        # would empty the partitions it has no rows for.
        # The last column is the partition; rows are gathered by it, and a large
        # partition is split again, so that files are neither many nor huge.
        columns = self.frame(name).columns
        even = df.select(*columns).hint("rebalance", columns[-1])
        with _dynamic_overwrite(self.spark):
            even.write.insertInto(self.prefix + name, overwrite=True)
        self.spark.catalog.refreshTable(self.prefix + name)

    def append(self, df: DataFrame, name: str) -> None:
        """Append rows that the table lacks."""
        df.select(*self.frame(name).columns).write.insertInto(self.prefix + name)
        self.spark.catalog.refreshTable(self.prefix + name)
