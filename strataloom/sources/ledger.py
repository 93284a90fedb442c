"""A ledger of loads: which have begun, which have ended, and what readers may see.

A load is noted before its first table is touched and again after its last.  A load noted
once only was interrupted, or still runs; readers of ``visible`` see the tables without
it, and repeating the load completes it.  Versions carry the time of their load as their
start or end and facts carry its hour, so leaving a load out is a filter on constants, of
which there are as many as loads in progress.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.moments import date_id_of
from ..operators.versions import open_end
from ..schemas import table
from .tables import Warehouse

BEGUN, ENDED = "begun", "ended"
COLUMNS = "loaded_at timestamp, state string, tables array<string>, noted_at timestamp, days array<int>"


@dataclass(frozen=True)
class Ledger:
    """The notes of one warehouse, a file per note."""

    warehouse: Warehouse

    @property
    def path(self) -> str:
        return f"{self.warehouse.root}/_loads"

    def note(self, loaded_at: dt.datetime, state: str, tables: Iterable[str], days: Iterable[int] = ()) -> None:
        """``days`` are the days whose facts the load has written."""
        row = (loaded_at, state, sorted(tables), dt.datetime.now(dt.timezone.utc), sorted(days))
        note = self.warehouse.spark.createDataFrame([row], COLUMNS)
        note.coalesce(1).write.mode("append").parquet(self.path)

    def notes(self) -> DataFrame:
        spark = self.warehouse.spark
        spark.createDataFrame([], COLUMNS).limit(0).write.mode("append").parquet(self.path)
        return spark.read.schema(COLUMNS).parquet(self.path)

    def finished(self) -> DataFrame:
        """``loaded_at, tables``: loads that are whole."""
        return self.notes().where(F.col("state") == ENDED).select("loaded_at", "tables").distinct()

    def changed_days(self, name: str) -> DataFrame:
        """``loaded_at, noted_at, days`` of every ended run of a load that wrote a table."""
        ended = self.notes().where((F.col("state") == ENDED) & F.array_contains("tables", name))
        return ended.select("loaded_at", "noted_at", "days")

    def unfinished(self, name: str | None = None) -> list[dt.datetime]:
        """Loads that have begun and not ended, of one table or of any."""
        notes = self.notes()
        if name:
            notes = notes.where(F.array_contains("tables", name))
        open_ = notes.groupBy("loaded_at").agg(F.bool_or(F.col("state") == ENDED).alias("over"))
        text = F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
        found = open_.where("NOT over").select(text).collect()
        return sorted(dt.datetime.fromisoformat(r["at"]).replace(tzinfo=dt.timezone.utc) for r in found)


def _is_any(column: str, moments: list[dt.datetime]) -> Column:
    return F.coalesce(F.col(column).isin([F.lit(m) for m in moments]), F.lit(False))


def visible(warehouse: Warehouse, name: str) -> DataFrame:
    """A table without the loads that have not ended.

    Versions begun by such a load are left out, versions it has ended are open again, its
    facts and the bridges of its versions are left out.  Names that it has added to a
    dictionary stay: nothing visible points at them, and the repeated load adds no second
    one.  Loads are told apart by their time; an hour has one load of an entity.
    """
    spec, rows = table(name), warehouse.frame(name)
    open_ = Ledger(warehouse).unfinished(name)
    if not open_:
        return rows
    if spec.versioned:
        again = _is_any("valid_to", open_)
        reopened = rows.where(~_is_any("valid_from", open_)).withColumns({
            "valid_to": F.when(again, open_end(F.col("valid_from"))).otherwise(F.col("valid_to")),
            "is_current": again | F.col("is_current"),
        })
        # Between two writes a version lies in the live and in the ended part.
        return reopened.dropDuplicates(["id"])
    if {"date_id", "time_id"} <= set(spec.column_names):
        hours = [F.struct(F.lit(date_id_of(m.date())).alias("d"), F.lit(m.hour).alias("t")) for m in open_]
        at = F.struct(F.col("date_id").alias("d"), F.col("time_id").alias("t"))
        rows = rows.where(~F.coalesce(at.isin(hours), F.lit(False)))
    # Rows may be there before the versions they point at.
    for column, target in spec.refs.items():
        if table(target).versioned:
            known = visible(warehouse, target).select(F.col("id").alias(column))
            rows = rows.join(known, column, "left_semi").select(*spec.column_names)
    return rows
