"""Stored day partials, kept up to date by the loads that have ended.

The ledger says which days a load wrote facts of.  An update computes the partials of the
days of all ended loads that it has not merged yet, replaces those days, and then notes
the loads as merged; a run that dies before its note is repeated and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partials import SCORE, DayPartials, day_lines, model_days
from ..session import stored
from .ledger import Ledger, visible
from .tables import Warehouse

FACTS = "dds.fact_models_metrics"
MERGED = "loaded_at timestamp, noted_at timestamp"


@dataclass(frozen=True)
class DayStore:
    """Partials under ``root``, partitioned by day; ``key`` is the type of model ids."""

    spark: SparkSession
    root: str
    key: str = "string"

    @property
    def _models_ddl(self) -> str:
        return (
            f"model_id {self.key}, score {SCORE}, scored long, snapshots long, downloads long, "
            "last struct<time_id: int, downloads: long, likes: long, trending_score: double>, date_id int"
        )

    _lines_ddl = f"score {SCORE}, scored long, snapshots long, distinct_models long, median double, date_id int"

    def _frame(self, name: str, ddl: str) -> DataFrame:
        try:
            return self.spark.read.schema(ddl).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ddl)

    def _replace(self, rows: DataFrame, name: str, ddl: str, days: Sequence[int]) -> None:
        """Replace the given days and no other.

        Every one of them gets a row without content too, so that a day that has lost all
        its rows is replaced like the others.
        """
        empty = self.spark.createDataFrame([(d,) for d in days], "date_id int")
        columns = self.spark.createDataFrame([], ddl).schema
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])
        whole = typed.unionByName(empty, allowMissingColumns=True)
        (
            whole.hint("rebalance", "date_id")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("date_id").parquet(f"{self.root}/{name}")
        )

    def replace_days(self, metrics: DataFrame, days: Sequence[int]) -> None:
        """Compute the partials of ``days`` anew from ``metrics``; other days stay unread."""
        if not days:
            return
        own = metrics.where(F.col("date_id").isin(*days))
        self._replace(model_days(own), "models", self._models_ddl, days)
        fresh = self.read().models.where(F.col("date_id").isin(*days))
        self._replace(day_lines(fresh, own), "lines", self._lines_ddl, days)

    def read(self) -> DayPartials:
        return DayPartials(
            self._frame("models", self._models_ddl).where("snapshots > 0"),
            self._frame("lines", self._lines_ddl).where("snapshots > 0"),
        )

    def update(self, warehouse: Warehouse) -> list[int]:
        """Merge what ended loads have changed; the days that were computed anew."""
        ended = Ledger(warehouse).changed_days(FACTS)
        merged = self._frame("merged", MERGED)
        # Stored before use, so that the note names the loads whose days were merged even
        # if another load ends meanwhile.  A row per load since the last update.
        news = stored(ended.join(merged, ["loaded_at", "noted_at"], "left_anti"), "ended-loads")
        days = [r[0] for r in news.select(F.explode("days").alias("d")).distinct().orderBy("d").collect()]
        self.replace_days(visible(warehouse, FACTS), days)
        news.select("loaded_at", "noted_at").write.mode("append").parquet(f"{self.root}/merged")
        return days
