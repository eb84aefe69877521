"""Dimension tables that are set up by rows of a configuration table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemart.fixed import DEFAULT_PK, DIMENSION_TYPES
from tidemart.operators.changelog import flatten_envelopes
from tidemart.operators.keyed import latest_by_key
from tidemart.operators.skew import skewed_join
from tidemart.schemas import TABLE_CONFIG


def current_config(envelopes: DataFrame, version: Sequence[str]) -> DataFrame:
    """Configuration in force: the last image of each source table.

    A delete has no image and changes nothing.  ``version`` names columns of the
    envelopes that order the changes of a row.
    """
    images = flatten_envelopes(envelopes, keep=version)
    config = images.where(F.size("after") > 0).select(
        *[F.col("after")[f.name].alias(f.name) for f in TABLE_CONFIG.fields], *version)
    latest = latest_by_key(config, ["source_table"], list(version)) if version else config
    pk = F.when(F.coalesce(F.col("sink_pk"), F.lit("")) == "", DEFAULT_PK).otherwise(
        F.col("sink_pk"))
    return latest.drop(*version).withColumn("sink_pk", pk).withColumn(
        "sink_extend", F.coalesce(F.col("sink_extend"), F.lit("")))


def route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Changes of configured tables, cut down to the configured columns.

    Adds ``sink_table`` and ``sink_pk``.  The key stays, whether it is a configured column
    or not.  Other tables and change types are left out.
    There are few source tables and one may have most of the changes, so the changes of the
    busy ones are cut by their number of rows and not all sent to one task.
    """
    setup = config.select(F.col("source_table").alias("table"), "sink_table", "sink_pk",
                          F.split("sink_columns", ",").alias("_columns"))
    kept = changes.where(F.col("type").isin(*DIMENSION_TYPES))
    joined = skewed_join(kept, setup, ["table"])
    data = F.map_filter("data", lambda k, _: F.array_contains("_columns", k) | (k == F.col("sink_pk")))
    return joined.withColumn("data", data).select(*changes.columns, "sink_table", "sink_pk")


def column_list(sink_columns: str, sink_pk: str | None = None) -> list[str]:
    """Columns of a dimension table, its key first."""
    pk = sink_pk or DEFAULT_PK
    names = sink_columns.split(",")
    return [pk] + [n for n in names if n != pk]


def table_schema(sink_columns: str, sink_pk: str | None = None) -> T.StructType:
    """Schema of a dimension table: all text, the key not null."""
    pk = sink_pk or DEFAULT_PK
    return T.StructType([T.StructField(n, T.StringType(), n != pk)
                         for n in column_list(sink_columns, sink_pk)])


def create_table_sql(sink_table: str, sink_columns: str, sink_pk: str | None = None,
                     sink_extend: str | None = None, part: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a first configuration row; ``part`` names a whole
    number by which the table is partitioned."""
    schema = table_schema(sink_columns, sink_pk)
    body = [f"`{f.name}` STRING{'' if f.nullable else ' NOT NULL'}" for f in schema.fields]
    split = f" PARTITIONED BY (`{part}`)" if part else ""
    return (f"CREATE TABLE IF NOT EXISTS {sink_table} ({', '.join([*body, *([f'`{part}` INT'] if part else [])])}) "
            f"USING parquet{split} {sink_extend or ''}").strip()


def cells(routed: DataFrame, version: Sequence[str]) -> DataFrame:
    """``key, cells`` of routed changes of one table: by column, its version and value."""
    key = F.col("data")[F.col("sink_pk")]
    cell = F.transform_values("data", lambda _, v: F.struct(*version, v.alias("value")))
    return routed.where(key.isNotNull()).select(key.alias("key"), cell.alias("cells"))


def merged_cells(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per key: of each column the value with the highest version.

    ``keep`` names further columns, that are equal for a key or of which the largest is kept.
    Cells are added up in the input tasks; a key has as many as its table has columns.
    """
    each = rows.select("key", *keep, F.explode("cells").alias("name", "cell"))
    best = each.groupBy("key", "name").agg(F.max("cell").alias("cell"), *[F.max(c).alias(c) for c in keep])
    return best.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("name", "cell"))).alias("cells"),
                                   *[F.max(c).alias(c) for c in keep])


def wide(rows: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns of a dimension table from its cells."""
    return rows.select(*[F.col("cells")[c]["value"].alias(c) for c in columns], *keep)


def keyless(routed: DataFrame) -> DataFrame:
    """Routed changes without a value for their key: dead letters, in no dimension table."""
    return routed.where(F.col("data")[F.col("sink_pk")].isNull())


def upserted(changes: DataFrame, sink_table: str, columns: Sequence[str], pk: str,
             version: Sequence[Column | str]) -> DataFrame:
    """Rows of one dimension table after all routed changes.

    A change writes only the columns it carries; the others keep their value.  That
    is one aggregate per table, combined before the shuffle: per column the value
    with the highest version among the changes that carry the column.  Changes without
    a key are left out; :func:`keyless` gives them.
    """
    rows = changes.where((F.col("sink_table") == sink_table) & F.col("data")[pk].isNotNull())
    order = F.struct(*version)

    def newest(name: str) -> Column:
        carried = F.when(F.map_contains_key(F.col("data"), F.lit(name)), order)
        return F.max_by(F.col("data")[name], carried).alias(name)

    return (rows.groupBy(F.col("data")[pk].alias(pk))
                .agg(*[newest(c) for c in columns if c != pk])
                .select(*columns))
