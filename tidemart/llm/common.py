"""Words, lengths and rows: what several operators share.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed
and carriage return, the white space on which ``bytes.split`` splits as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    blank = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(blank, " "), "")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text of an Arrow column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def numbered(df: DataFrame, *columns: Column) -> DataFrame:
    """The columns and ``rid``, a number that tells equal rows apart.

    It depends on the partition and the place in it, so it stays the same when a lost
    task of a scan runs again; number only what comes from a scan.
    """
    return df.select(F.monotonically_increasing_id().alias("rid"), *columns)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut a sorted partition so that rows of equal keys stay together.

    What is kept back between batches is the last run only.
    """
    import numpy as np
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        same = np.ones(table.num_rows, dtype=bool)
        for key in keys:
            column = table.column(key).to_numpy()
            same &= column == column[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None:
        yield held


def text_mark(text: Column) -> Column:
    """A hash of a text, to tell rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def row_name(doc_id: Column, mark: Column) -> Column:
    return F.concat_ws(":", doc_id.cast("string"), mark.cast("string"))


def kept_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The documents whose ``doc_id, mark`` has a verdict ``kept``, columns unchanged; rows of
    one id and text stay or go together."""
    kept = verdicts.where("kept").select(row_name(F.col("doc_id"), F.col("mark")).alias("kept_name")).distinct()
    named = docs.select(F.struct("*").alias("doc"), row_name(docs["doc_id"].cast("long"), text_mark(docs["text"])).alias("name"))
    return named.join(kept, named["name"] == kept["kept_name"], "left_semi").select("doc.*")
