"""Dimension maintenance job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tidemart.operators import dims


def route_changes(log: DataFrame, envelopes: DataFrame,
                  version: Sequence[str] = ()) -> DataFrame:
    """Changes of the configured tables, with their target table and its key."""
    return dims.route(log, dims.current_config(envelopes, version))


def dimension_table(routed: DataFrame, sink_table: str, sink_columns: str,
                    version: Sequence[Column | str], sink_pk: str | None = None) -> DataFrame:
    """One dimension table from its routed changes."""
    columns = dims.column_list(sink_columns, sink_pk)
    return dims.upserted(routed, sink_table, columns, columns[0], version)
