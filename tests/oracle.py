"""Compare a named query with its SQL statement in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        view = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(r[i] for i in order) for r in rows]
    return sorted(columns), sorted(picked, key=repr)


SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN"}


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """Rows of the query, and '' or what differs."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    want_columns, want = _rows(names, expected.fetchall())
    got_columns, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_columns != want_columns:
        return len(got), f"columns {got_columns} != {want_columns}"
    for field in spark_df.schema:
        kind = field.dataType.simpleString()
        if SAME.get(kind) != types[field.name]:
            return len(got), f"{field.name}: {kind} != {types[field.name]}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows != {len(want)}"
    if got != want:
        different = [(g, w) for g, w in zip(got, want) if g != w]
        return len(got), f"{len(different)} rows differ, first {different[0]}"
    return len(got), ""
