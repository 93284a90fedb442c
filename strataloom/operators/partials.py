"""Day partials: what one day of model metrics contributes to the marts.

Sums, counts and last snapshots merge over days, so a mart of a week or a month reads one
row per model and day instead of every snapshot.  The median does not merge; it is kept
per day, which is how the trend mart shows it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import exact
from .ranking import percentile_by

SCORE = "decimal(38,12)"
LAST = ("time_id", "downloads", "likes", "trending_score")


@dataclass(frozen=True)
class DayPartials:
    """``models`` has a row per model and day, ``lines`` a row per day."""

    models: DataFrame
    lines: DataFrame

    def last_snapshots(self) -> DataFrame:
        """The last snapshot of each model and day, in the columns of the metrics."""
        return self.models.select("model_id", "date_id", *[F.col("last")[c].alias(c) for c in LAST])

    def per_model(self) -> DataFrame:
        """Sums of all snapshots of a model."""
        return self.models.groupBy("model_id").agg(
            F.sum("score").alias("score"),
            F.sum("scored").alias("snapshots"),
            F.sum("downloads").alias("downloads"),
        )


def model_days(metrics: DataFrame) -> DataFrame:
    """``date_id, model_id`` with sums, counts and the last snapshot of the day.

    Rows are combined before the shuffle: a model with a third of all snapshots sends one
    row per day and input partition.  Snapshots of one hour are told apart by their
    figures; NULLs come last.
    """
    return metrics.groupBy("date_id", "model_id").agg(
        F.sum(exact(F.col("trending_score"))).cast(SCORE).alias("score"),
        F.count("trending_score").alias("scored"),
        F.count(F.lit(1)).alias("snapshots"),
        F.sum("downloads").alias("downloads"),
        F.max(F.struct(*LAST)).alias("last"),
    )


def day_lines(models: DataFrame, metrics: DataFrame) -> DataFrame:
    """A row per day: sums from its model rows, the exact median from its snapshots."""
    sums = models.groupBy("date_id").agg(
        F.sum("score").cast(SCORE).alias("score"),
        F.sum("scored").alias("scored"),
        F.sum("snapshots").alias("snapshots"),
        F.count(F.lit(1)).alias("distinct_models"),
    )
    median = percentile_by(metrics, ["date_id"], "trending_score", 0.5, "median", few_groups=True)
    return sums.join(median, "date_id", "left")
