"""Sources: message streams, files, change logs, JDBC tables and text records.

Streams of one kind share one contract, a text column ``value``; what reads them
does not know whether it came from a topic or from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemart.functions.names import camel_columns
from tidemart.operators.changelog import flatten_envelopes


def _not_null(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"))


def topic(spark: SparkSession, servers: str, name: str, earliest: bool = False,
          max_per_batch: int | None = None) -> DataFrame:
    """Text messages of a topic.  Needs the Kafka package on the class path.

    Offsets are kept in the checkpoint of the query that reads the stream.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", name)
              .option("startingOffsets", "earliest" if earliest else "latest"))
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return _not_null(reader.load())


def topic_batch(spark: SparkSession, servers: str, name: str) -> DataFrame:
    """All messages of a topic so far, as a batch."""
    return _not_null(spark.read.format("kafka")
                     .option("kafka.bootstrap.servers", servers)
                     .option("subscribe", name).load())


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return _not_null(spark.read.text(path))


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files of a folder, one message per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _not_null(reader.text(path))


def table_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                 files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def space_records(lines: DataFrame, fields: dict[str, str], value: str = "value") -> DataFrame:
    """Space-separated lines to typed columns, such as ``{"id": "string", "ts": "bigint"}``."""
    parts = F.split(F.col(value), " ")
    return lines.select(*[F.get(parts, F.lit(i)).try_cast(kind).alias(name)
                          for i, (name, kind) in enumerate(fields.items())])


def jdbc_table(spark: SparkSession, url: str, table: str, driver: str | None = None,
               user: str | None = None, password: str | None = None,
               split_by: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A table over JDBC; ``split_by`` is (column, lowest, highest, parts)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for name, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            reader = reader.option(name, value)
    if split_by:
        column, low, high, parts = split_by
        reader = (reader.option("partitionColumn", column).option("lowerBound", low)
                        .option("upperBound", high).option("numPartitions", parts))
    return reader.load()


def jdbc_query(spark: SparkSession, url: str, sql: str, driver: str | None = None,
               camel: bool = False, **options: str) -> DataFrame:
    """Result of a query run by the database, with camel-case names on request."""
    reader = spark.read.format("jdbc").option("url", url).option("query", sql)
    if driver:
        reader = reader.option("driver", driver)
    result = reader.options(**options).load()
    return camel_columns(result) if camel else result


def dictionary(table: DataFrame) -> DataFrame:
    """Code dictionary ``dic_code, dic_name, parent_code`` as text."""
    return table.select(*[F.col(c).cast("string").alias(c)
                          for c in ("dic_code", "dic_name", "parent_code")])


def snapshot_then_changes(snapshot: DataFrame, table: str, envelopes: DataFrame) -> DataFrame:
    """A table's rows as snapshot changes, together with the changes made to it later.

    A stream cannot be unioned with a batch: for streaming ``envelopes`` write the
    snapshot as the first files of the stream's folder or topic.
    """
    image = F.map_from_arrays(F.array(*[F.lit(c) for c in snapshot.columns]),
                              F.array(*[F.col(c).cast("string") for c in snapshot.columns]))
    empty = F.create_map().cast("map<string,string>")
    first = snapshot.select(
        empty.alias("before"), image.alias("after"),
        F.struct(F.lit(table).alias("table")).alias("source"), F.lit("r").alias("op"))
    return flatten_envelopes(first).unionByName(flatten_envelopes(envelopes))


def with_snapshot(spark: SparkSession, snapshot: DataFrame, table: str, folder: str, position: str, at: int) -> None:
    """Put a table's snapshot, taken at a position of its change stream, into the folder of
    envelopes that a stream reads; call it once, before the stream starts."""
    image = F.map_from_arrays(F.array(*[F.lit(c) for c in snapshot.columns]),
                              F.array(*[F.col(c).cast("string") for c in snapshot.columns]))
    schema = spark.read.parquet(folder).schema
    rows = snapshot.select(F.create_map().cast("map<string,string>").alias("before"), image.alias("after"),
                           F.struct(F.lit(table).alias("table")).alias("source"), F.lit("r").alias("op"),
                           F.lit(at).cast("long").alias(position))
    every = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    rows.select(*every).write.mode("append").parquet(folder)


def handed_over(envelopes: DataFrame, position: str, at: int) -> DataFrame:
    """Of a stream that starts with a snapshot, the snapshot and the changes made after it:
    those up to its position, which the change stream repeats, are in it already."""
    return envelopes.where((F.col("op") == "r") | (F.col(position) > at))
