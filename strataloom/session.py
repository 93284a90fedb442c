"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on.  Timestamps are UTC instants, and
# adaptive execution splits hot join partitions even where that costs one more
# exchange, because a single key may hold a large share of all rows.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Start-up settings for a cluster; the initial partition number is generous and
# adaptive execution merges what turns out small.
CLUSTER_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

SCRATCH_KEY = "spark.checkpoint.dir"
_local_scratch: str | None = None


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strataloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a session that has
    none (a test on one machine) gets a temporary folder of its own.
    """
    named = spark.conf.get(SCRATCH_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SCRATCH_KEY} to a folder all executors share")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="strataloom-")
    return _local_scratch


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the scratch root that nothing has written to yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch area and read it back; cuts its lineage."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Even out a scan that has fewer splits than there are cores.

    Worth it only before heavy per-row work on few files; a scan with enough
    splits is returned as it is, without a shuffle.  ``keys`` should be close to
    unique.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
