"""Run registered queries beside their reference SQL and compare the results."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def reference(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def differences(spark, folder, name, con) -> str | None:
    """None if the query and its SQL agree, else what is different."""
    import __spark_entry__ as entry
    df = entry.queries()[name](spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {c: k for c, k in df.dtypes}
    theirs = rows_of(names, cursor.fetchall())
    for d in cursor.description:
        short = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}.get(kinds[d[0]])
        if short and str(d[1]) != short:
            return f"column {d[0]} is {kinds[d[0]]} against {d[1]}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"row {a} against {b}"
    return None


def main(argv: list[str]) -> int:
    from conftest import make_session
    import __spark_entry__ as entry
    folder = argv[0]
    spark, con = make_session(), reference(folder)
    bad = 0
    for name in argv[1:] or entry.queries():
        began = time.time()
        try:
            if name in entry.oracle_sql():
                found = differences(spark, folder, name, con) or "same"
            else:
                found = f"no SQL, {entry.queries()[name](spark, folder).count()} rows"
        except Exception as error:
            found = f"FAILED {type(error).__name__} {str(error)[:600]}"
        bad += not (found == "same" or found.startswith("no SQL"))
        print(f"{name:28s} {time.time() - began:6.2f}s  {found}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
