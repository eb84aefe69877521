"""Session set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL settings that may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even if that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keep state of streaming queries on local disk with snapshots in the
    # checkpoint folder, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Of tables that micro-batches write, for which the default codec takes a third more.
COMPRESSION = "zstd"


def tune(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """Apply the runtime settings; ``time_zone`` is used to parse and to format."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if time_zone:
        spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def build_session(app: str = "tidemart", time_zone: str = "GMT+8",
                  master: str | None = None, **conf: str) -> SparkSession:
    """Session with one time zone for both directions of every date function."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate(), time_zone)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for a checkpoint or a written table, visible to all executors.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    do without; it then gets a folder of its own on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemart-")
    return f"{base.rstrip('/')}/tidemart/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a frame to a new table in the shared folder and read it back.

    For results that are read several times.  Unlike a cached frame it survives the
    loss of executors.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
