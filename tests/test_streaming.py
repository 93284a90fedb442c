"""Streams deliver the same as batches, also over several runs."""

import datetime as dt
import os

from pyspark.sql.types import StructType

from strataloom.operators import latest
from strataloom.sources.staging import write_staged_json
from strataloom.streaming import incremental

UTC = dt.timezone.utc


def test_loads_arrive_in_order_and_once(spark, tmp_path):
    seen = []

    def apply(rows, moment):
        seen.append((moment.day, sorted(r.id for r in rows.collect())))

    def run():
        stream = incremental.landed_stream(spark, f"{tmp_path}/in/entity=m/stage=raw", "id string")
        incremental.apply_loads(
            stream, apply, f"{tmp_path}/progress", f"{tmp_path}/rejects"
        ).awaitTermination()

    def land(day, *ids):
        df = spark.createDataFrame([(i,) for i in ids], "id string")
        stamp = incremental.folder_time(dt.datetime(2024, 1, day, tzinfo=UTC))
        write_staged_json(df, f"{tmp_path}/in", "m", "raw", stamp)

    land(2, "c")
    land(1, "a", "b")
    run()
    assert seen == [(1, ["a", "b"]), (2, ["c"])]
    run()
    land(3, "d")
    run()
    assert seen[2:] == [(3, ["d"])]


def at(hour, minute, day=1):
    return dt.datetime(2024, 1, day, hour, minute, tzinfo=UTC)


EVENTS = StructType().add("k", "string").add("ts", "timestamp").add("n", "integer")
THREE_LOADS = [
    [("a", at(1, 10), 1), ("a", at(1, 50), 2), ("b", at(1, 0), 3), (None, at(1, 5), 8)],
    [("a", at(1, 55), 4), ("a", at(9, 5), 5), ("e", at(0, 5, 3), 1)],
    # Days and hours behind the newest event: older, newer and equal to what is stored.
    [("a", at(1, 20), 6), ("a", at(1, 56), 9), ("b", at(1, 0), 2), ("c", at(2, 30), 7),
     ("e", at(0, 59, 3), 2), (None, at(1, 6), 9), ("d", None, 1), ("d", None, 3)],
]


def rolled(spark, folder, out, *loads, write):
    for number, load in enumerate(loads):
        write(spark.createDataFrame(load, EVENTS), number)
        incremental.hourly_upserts(
            incremental.table_stream(spark, folder, "events", EVENTS), ["k"], "ts", ["n"],
            f"{out}/out", f"{out}/progress",
        ).awaitTermination()
    return incremental.read_hourly(spark, f"{out}/out", EVENTS)


def plain_hours(loads):
    best = {}
    for k, ts, n in (row for load in loads for row in load):
        key = k, ts and ts.replace(minute=0)
        rank = (ts is not None, ts or 0, n)
        if key not in best or rank > best[key]:
            best[key] = rank
    return sorted((str(k), str(h and h.replace(tzinfo=None)), n) for (k, h), (*_, n) in best.items())


def shown(rows):
    return sorted((str(r.k), str(r.hour), r.n) for r in rows.collect())


def test_hourly_state_late_rows_and_restarts(spark, tmp_path):
    """Three micro-batches, each a new start from the checkpoint, over a folder of parts."""
    table = f"{tmp_path}/events.parquet"
    got = rolled(
        spark, tmp_path, tmp_path, *THREE_LOADS,
        write=lambda df, n: df.coalesce(1).write.mode("append").parquet(table),
    )
    assert shown(got) == plain_hours(THREE_LOADS)
    late = spark.read.parquet(f"{tmp_path}/out/late")
    assert {(r.k, r.n) for r in late.where("micro_batch >= 2").collect()} >= {("a", 9), ("c", 7), (None, 9), ("d", 3)}
    assert ("e", 2) not in {(r.k, r.n) for r in late.collect()}
    batch = latest.hourly_latest(spark.read.parquet(table), ["k"], "ts", ["n"])
    assert shown(batch) == shown(got)


def test_hourly_table_of_one_file_and_of_nothing(spark, tmp_path):
    one = [row for load in THREE_LOADS for row in load]

    def write(df, n):
        df.coalesce(1).write.parquet(f"{tmp_path}/parts")
        (part,) = tmp_path.glob("parts/part-*.parquet")
        part.rename(tmp_path / "events.parquet")

    got = rolled(spark, tmp_path, tmp_path, one, write=write)
    assert shown(got) == plain_hours([one])
    assert incremental.read_hourly(spark, f"{tmp_path}/never", EVENTS).count() == 0


def test_merging_hours_rewrites_touched_days_only(spark, tmp_path):
    table = f"{tmp_path}/hours"

    def merge(*rows):
        df = spark.createDataFrame(rows, EVENTS).selectExpr("*", "date_trunc('HOUR', ts) AS hour")
        incremental.merge_hours(df, ["k"], "ts", ["n"], table)

    merge(("a", at(1, 0), 1), ("a", at(1, 0, 2), 1))
    files = {day: sorted(os.listdir(f"{table}/_day=2024-01-0{day}")) for day in (1, 2)}
    for _ in range(2):
        merge(("a", at(1, 30, 2), 5))
        assert sorted(os.listdir(f"{table}/_day=2024-01-01")) == files[1]
        assert sorted(os.listdir(f"{table}/_day=2024-01-02")) != files[2]
    assert {(r.ts.day, r.n) for r in spark.read.schema(EVENTS).parquet(table).collect()} == {(1, 1), (2, 5)}
