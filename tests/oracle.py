"""Run a query and its SQL counterpart and compare them value by value."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types, row count and values; empty when equal.

    An empty result is a difference too: it would prove nothing.
    """
    found = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in found.description}
    sql_rows = found.fetchall()
    spark_rows = [tuple(r.asDict(recursive=True).values()) for r in df.collect()]
    out = []
    if sorted(df.columns) != sorted(sql_types):
        return [f"columns {sorted(df.columns)} != {sorted(sql_types)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != sql_types[name] and not kind.startswith(("array", "struct")):
            out.append(f"type of {name}: {kind} != {sql_types[name]}")
    if not sql_rows:
        out.append("no rows")
    if len(spark_rows) != len(sql_rows):
        out.append(f"rows {len(spark_rows)} != {len(sql_rows)}")
    ours, theirs = canonical(df.columns, spark_rows), canonical(list(sql_types), sql_rows)
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        out.append(f"{len(wrong)} values differ, first {wrong[0]}")
    return out
