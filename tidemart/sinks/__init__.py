"""Sinks.  Every writer that runs per micro-batch can be replayed without harm."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemart.operators.keyed import latest_by_key
from tidemart.operators.windows import stamped
from tidemart.session import COMPRESSION

BATCH = "batch_id"
BatchWriter = Callable[[DataFrame, int], None]


def as_messages(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Rows as JSON text in ``value``, and the key columns as JSON in ``key``."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.to_json(F.struct(*key)).alias("key"), value) if key else df.select(value)


def to_topic(df: DataFrame, servers: str, name: str, checkpoint: str) -> DataStreamWriter:
    """Append messages (``value`` and optionally ``key``) to a topic."""
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("topic", name).option("checkpointLocation", checkpoint))


def to_files(df: DataFrame, path: str, checkpoint: str, kind: str = "parquet") -> DataStreamWriter:
    """Append to files; the file sink's own log makes each micro-batch count once."""
    return (df.writeStream.format(kind).option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append"))


def to_console(df: DataFrame, checkpoint: str) -> DataStreamWriter:
    return (df.writeStream.format("console").option("truncate", "false")
              .option("checkpointLocation", checkpoint))


def _write_batch(df: DataFrame, batch: int, path: str) -> None:
    # One folder per micro-batch, written whole: a replay replaces what it wrote.
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{path}/{BATCH}={batch}")


def append_batches(path: str, drop: Sequence[str] = ()) -> BatchWriter:
    """Append each micro-batch as a partition, without the columns in ``drop``."""
    def write(df: DataFrame, batch: int) -> None:
        _write_batch(df.drop(*drop), batch, path)
    return write


def upsert_batches(path: str, keys: Sequence[str], version: Sequence[str] = (), stamp: bool = False) -> BatchWriter:
    """Keep the latest row per key; read the table back with :func:`read_upserted`.

    With ``stamp`` rows get ``ts``, the time of their computation in milliseconds, as versioned
    tables elsewhere need it.

    Each micro-batch is first cut to its last row per key and then added as a
    partition, so its cost follows the size of the batch and not of the table.
    Without ``version`` a micro-batch must hold each key at most once.
    """
    def write(df: DataFrame, batch: int) -> None:
        rows = latest_by_key(df, keys, version) if version else df
        _write_batch(stamped(rows) if stamp else rows, batch, path)
    return write


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str],
                  version: Sequence[str] = ()) -> DataFrame:
    """The table that :func:`upsert_batches` keeps: the last row of each key."""
    rows = spark.read.option("basePath", path).parquet(path)
    return latest_by_key(rows, keys, [*version, BATCH]).drop(BATCH)


def compact(spark: SparkSession, path: str, into: str, keys: Sequence[str],
            version: Sequence[str] = ()) -> None:
    """Write the current state of an upserted table to a new folder, as its batch 0."""
    _write_batch(read_upserted(spark, path, keys, version), 0, into)


def positional(df: DataFrame, transient: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """Columns in insert order without the transient ones; checks the column count."""
    out = df.drop(*transient)
    if width is not None and len(out.columns) != width:
        raise ValueError(f"{len(out.columns)} columns for {width} places")
    return out


def jdbc_batches(url: str, table: str, driver: str | None = None,
                 transient: Sequence[str] = (), batch_size: int = 10_000,
                 **options: str) -> BatchWriter:
    """Insert each micro-batch over JDBC, in column order.

    JDBC inserts cannot be undone, so the batch number is written with the rows; the
    target must keep one version per (key, batch), as versioned tables do.
    """
    def write(df: DataFrame, batch: int) -> None:
        writer = (positional(df, transient).withColumn(BATCH, F.lit(batch))
                  .write.format("jdbc").mode("append").option("url", url)
                  .option("dbtable", table).option("batchsize", batch_size).options(**options))
        (writer.option("driver", driver) if driver else writer).save()
    return write


def for_each(df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append",
             ) -> DataStreamWriter:
    """Run a batch writer on each micro-batch of a stream."""
    return (df.writeStream.outputMode(mode).foreachBatch(write)
              .option("checkpointLocation", checkpoint))
