"""Reading JSON lines and routing application logs.

Records stay VARIANT values where a record must pass through whole, so fields that
no schema here names are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart import schemas

_DOC = "_doc"
_RECORD = "map<string,variant>"


def parsed(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``_doc``: the record as a map of VARIANT, null if it is no JSON object."""
    doc = F.try_variant_get(F.try_parse_json(F.coalesce(F.col(value), F.lit(""))), "$", _RECORD)
    return df.withColumn(_DOC, doc)


def split_valid(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records with ``_doc``, dead letters).  A null or empty payload is dead."""
    frame = parsed(df, value)
    return frame.where(F.col(_DOC).isNotNull()), frame.where(F.col(_DOC).isNull()).drop(_DOC)


def field(path: str, kind: str = "string") -> Column:
    """A field of the record, such as ``field("common.mid")``; null if missing."""
    head, _, rest = path.partition(".")
    return F.try_variant_get(F.col(_DOC)[head], f"$.{rest}" if rest else "$", kind)


def without(*names: str) -> Column:
    """The record as JSON text with some top-level fields left out."""
    return F.to_json(F.map_filter(_DOC, lambda k, _: ~k.isin(*names)))


def with_flag(flag: Column) -> Column:
    """The record with ``common.is_new`` replaced."""
    common = F.col(_DOC)["common"].try_cast(_RECORD)
    kept = F.map_filter(common, lambda k, _: k != "is_new")
    fixed = F.map_concat(kept, F.create_map(F.lit("is_new"), flag.cast("variant")))
    rest = F.map_filter(_DOC, lambda k, _: k != "common")
    return F.map_concat(rest, F.create_map(
        F.lit("common"), F.try_parse_json(F.to_json(fixed))))


def log_keys() -> list[Column]:
    """The three fields that new-visitor correction needs."""
    return [field("common.mid").alias("mid"), field("common.is_new").alias("is_new"),
            F.timestamp_millis(field("ts", "bigint")).alias("event_time")]


def is_usable() -> Column:
    """A log record has a device id, and a start or a page part."""
    parts = field("start", _RECORD).isNotNull() | field("page", _RECORD).isNotNull()
    return F.coalesce(field("common.mid").isNotNull() & parts, F.lit(False))


def routes(records: DataFrame) -> DataFrame:
    """``route, value`` for each record that a log line (``value`` with ``_doc``) leads to.

    A start record gives its start object only.  Any other gives a ``page`` record
    without its displays and actions, and one ``display`` or ``action`` per element
    with the page id and time added.  A record with an error text is also given whole
    as ``error``.  A line that is not usable is given as it is as ``dirty``.  All
    routes come out of one pass; write them with ``partitionBy("route")``.
    """
    def one(name: str, value: Column) -> Column:
        return F.array(_routed(name, value))

    def elements(field_name: str, name: str) -> Column:
        added = F.create_map(F.lit("page"), field("page.page_id").cast("variant"),
                             F.lit("ts"), field("ts").cast("variant"))
        items = F.try_variant_get(F.col(_DOC)[field_name], "$", "array<map<string,variant>>")
        full = F.transform(items, lambda item: _routed(name, F.to_json(F.map_concat(
            F.map_filter(item, lambda k, _: ~k.isin("page", "ts")), added))))
        return F.coalesce(full, F.array().cast("array<struct<route:string,value:string>>"))

    none = F.array().cast("array<struct<route:string,value:string>>")
    is_start = field("start", _RECORD).isNotNull()
    usual = F.when(is_start, one("start", F.to_json(F.col(_DOC)["start"]))).otherwise(F.concat(
        one("page", without("displays", "actions")),
        elements("displays", "display"), elements("actions", "action")))
    failed = F.when(F.coalesce(field("error"), F.lit("")) != "", one("error", without())).otherwise(none)
    every = F.when(is_usable(), F.concat(usual, failed)).otherwise(one("dirty", F.col("value")))
    return records.select(F.explode(every).alias("_r")).select("_r.route", "_r.value")


def _routed(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("route"), value.alias("value"))


def route(routed: DataFrame, name: str) -> DataFrame:
    """The lines of one route."""
    return routed.where(F.col("route") == name).select("value")


def page_log(df: DataFrame, value: str = "value") -> DataFrame:
    """Typed page log: ``common``, ``page``, ``ts`` and ``event_time``."""
    log = df.select(F.from_json(value, schemas.APP_LOG).alias("r")).select("r.*")
    return (log.where(F.col("page").isNotNull()).select("common", "page", "ts")
               .withColumn("event_time", F.timestamp_millis("ts")))


def change_log(df: DataFrame, value: str = "value") -> DataFrame:
    """Typed row change log, with the arrival time in ``proc_time``."""
    log = df.select(F.from_json(value, schemas.CHANGE_LOG).alias("r")).select("r.*")
    return (log.where(F.col("table").isNotNull())
               .withColumn("proc_time", F.current_timestamp()))
