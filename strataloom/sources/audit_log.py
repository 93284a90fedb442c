"""The audit of a fact table, brought up to date by the loads that have ended."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.audits import COUNTS, ORPHANS, PartAudit, audit_parts, carried, totals
from ..schemas import TABLES, table
from ..session import stored
from .ledger import Ledger, visible
from .tables import Warehouse

STATES = "state string, at timestamp, loads array<struct<loaded_at: timestamp, noted_at: timestamp>>"


@dataclass(frozen=True)
class AuditLog:
    """States of one table's audit under ``root``; a state is as small as its rules and parts.

    A new state is written beside the old one, and the note that makes it the valid one
    names the loads it has looked at; a run that dies before its note is repeated.
    """

    warehouse: Warehouse
    name: str
    root: str

    def _states(self) -> DataFrame:
        spark = self.warehouse.spark
        try:
            return spark.read.schema(STATES).parquet(f"{self.root}/states")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], STATES)

    def state(self) -> PartAudit:
        spark = self.warehouse.spark
        last = self._states().agg(F.max_by("state", "at")).first()[0]
        if last is None:
            return PartAudit(spark.createDataFrame([], COUNTS), spark.createDataFrame([], ORPHANS))
        return PartAudit(
            spark.read.schema(COUNTS).parquet(f"{self.root}/{last}/counts"),
            spark.read.schema(ORPHANS).parquet(f"{self.root}/{last}/orphans"),
        )

    def _targets(self) -> dict[str, DataFrame]:
        return {t: self.warehouse.frame(t) for t in table(self.name).refs.values() if t in TABLES}

    def update(self) -> list[int]:
        """Audit the parts that loads ended since the last update have written."""
        spec = table(self.name)
        (part,) = spec.partition_by
        seen = self._states().select(F.inline("loads"))
        # A row per load since the last update.
        news = stored(
            Ledger(self.warehouse).changed_days(self.name).join(seen, ["loaded_at", "noted_at"], "left_anti"),
            "ended-loads",
        )
        parts = [r[0] for r in news.select(F.explode("days").alias("d")).distinct().orderBy("d").collect()]
        if not parts:
            return []
        touched = visible(self.warehouse, self.name).where(F.col(part).isin(*parts))
        after = carried(self.state(), audit_parts(touched, spec, self._targets(), part), parts)
        state = f"state-{uuid.uuid4().hex}"
        after.counts.coalesce(1).write.parquet(f"{self.root}/{state}/counts")
        after.orphans.coalesce(1).write.parquet(f"{self.root}/{state}/orphans")
        loads = news.agg(F.collect_list(F.struct("loaded_at", "noted_at")).alias("loads"))
        loads.select(
            F.lit(state).alias("state"), F.lit(dt.datetime.now(dt.timezone.utc)).alias("at"), "loads"
        ).write.mode("append").parquet(f"{self.root}/states")
        return parts

    def report(self) -> DataFrame:
        """Violations per rule, equal to a full audit of what ended loads have written."""
        return totals(self.state(), table(self.name), self._targets())
