"""Landed loads applied one by one, and rollups over streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from ..operators.latest import latest_by_key
from ..session import stored
from ..sources.staging import CORRUPT

# How a load's time is spelled in its folder name.
_FOLDER_TIME = "%Y%m%dT%H%M%S"

ApplyLoad = Callable[[DataFrame, dt.datetime], None]


def folder_time(moment: dt.datetime) -> str:
    return moment.strftime(_FOLDER_TIME)


def landed_stream(spark: SparkSession, landing: str, ddl: str) -> DataFrame:
    """New staged records as they land; ``landing`` holds one folder per load."""
    schema = f"{ddl}, {CORRUPT} string, batch_ts string"
    return spark.readStream.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(landing)


def apply_loads(
    stream: DataFrame, apply: ApplyLoad, checkpoint: str, rejects: str | None = None
) -> StreamingQuery:
    """Run every landed load through ``apply``, oldest first, and stop when none is left.

    A micro-batch may hold several loads and may be delivered again after a
    failure; ``apply`` stores by key, so a second delivery changes nothing.
    Records that did not parse are written to ``rejects``.  Loads must land in
    time order and as a whole.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if rejects:
                broken = batch.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, "batch_ts")
                broken.write.mode("overwrite").json(f"{rejects}/micro_batch={batch_id}")
            readable = batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
            for row in readable.select("batch_ts").distinct().orderBy("batch_ts").collect():
                moment = dt.datetime.strptime(row.batch_ts, _FOLDER_TIME).replace(
                    tzinfo=dt.timezone.utc
                )
                load = readable.where(F.col("batch_ts") == row.batch_ts).drop("batch_ts")
                apply(load.withColumn("loaded_at", F.lit(moment)), moment)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def table_stream(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of part files.

    A stream wants a pattern for a single file; this one matches the table alone.
    """
    return spark.readStream.schema(schema).parquet(f"{folder}/{name[:-1]}[{name[-1]}].parquet")


def same_values(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Equal column by column, NULL being equal to NULL."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right)])


def hourly_upserts(
    stream: DataFrame,
    key: Sequence[str],
    moment: str,
    order: Sequence[str],
    path: str,
    checkpoint: str,
    delay: str = "2 hours",
) -> StreamingQuery:
    """Keep the last row per key and hour of a stream in a table by day.

    Open hours are state: a micro-batch gives the hours it has changed, each with its
    last row so far, and the watermark, ``delay`` behind the newest time, closes them.
    A row of a closed hour is not in the state's output any more; as a micro-batch puts
    out every open hour that it has a row for, the rows of hours it does not put out are
    the late ones, those without time among them.  They are written to a side folder and
    compared with what the table has.  Only the days of changed hours are read and
    rewritten.  A repeated micro-batch changes nothing, as the last row wins again.
    """
    columns = stream.columns
    last_row = F.max_by(F.struct(*columns), F.struct(moment, *order))
    open_hours = (
        stream.withWatermark(moment, delay)
        .groupBy(*key, F.window(moment, "1 hour").alias("_window"))
        .agg(last_row.alias("_row"))
        .select(F.lit(False).alias("_as_read"), "_row.*")
    )
    both = open_hours.unionByName(stream.select(F.lit(True).alias("_as_read"), *columns))
    hour = F.date_trunc("HOUR", F.col(moment))

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = stored(
            latest_by_key(batch.withColumn("hour", hour), ["_as_read", *key, "hour"], [moment, *order]),
            "hours",
        )
        kept = rows.where("NOT _as_read").drop("_as_read")
        known = kept.select(*[F.col(c).alias(f"_{c}") for c in (*key, "hour")])
        on = same_values([F.col(c) for c in (*key, "hour")], [F.col(f"_{c}") for c in (*key, "hour")])
        late = rows.where("_as_read").drop("_as_read").join(known, on, "left_anti")
        late.write.mode("overwrite").parquet(f"{path}/late/micro_batch={batch_id}")
        merge_hours(kept.unionByName(late), key, moment, order, f"{path}/hours")

    return (
        both.writeStream.outputMode("update")
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_hours(
    news: DataFrame, key: Sequence[str], moment: str, order: Sequence[str], path: str
) -> None:
    """Put rows into the hourly table at ``path``; per key and hour the last row stays.

    Days without news are neither read nor written.  Spark does not overwrite what it
    reads, so the new days pass through the shared scratch folder.
    """
    spark = news.sparkSession
    dated = news.withColumn("_day", F.to_date("hour"))
    days = [r[0] for r in dated.select("_day").distinct().collect()]
    if not days:
        return
    touched = F.col("_day").isin([d for d in days if d is not None])
    if None in days:
        touched = touched | F.col("_day").isNull()
    # The folder exists from here on, and has no rows before the first merge.
    dated.limit(0).write.mode("append").parquet(path)
    before = spark.read.schema(dated.schema).parquet(path).where(touched)
    merged = stored(
        latest_by_key(before.unionByName(dated), [*key, "hour"], [moment, *order]), "merged-hours"
    )
    (
        merged.hint("rebalance", "_day")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("_day").parquet(path)
    )


def read_hourly(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The hourly table that ``hourly_upserts`` keeps of a stream of ``schema``.

    Before the first row has come it is empty.
    """
    whole = StructType([*schema.fields, StructField("hour", TimestampType())])
    empty = spark.createDataFrame([], whole)
    empty.limit(0).write.mode("append").parquet(f"{path}/hours")
    return spark.read.schema(whole).parquet(f"{path}/hours")
