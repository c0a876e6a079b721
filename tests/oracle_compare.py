"""Compare Spark results with their DuckDB twins: columns, rows, values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, float):
        return f"double {value + 0.0!r}"
    if isinstance(value, int):
        return f"int {value}"
    if isinstance(value, (dt.date, dt.datetime)):
        return f"{type(value).__name__} {value}"
    return value


def _rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def difference(df, con, sql: str) -> str | None:
    """None when both results agree, a short description otherwise."""
    got = df.collect()
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    types = {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes}
    duck = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    if types != duck:
        return f"types { {n: (types[n], duck[n]) for n in types if types[n] != duck[n]} }"
    mine, theirs = _rows(df.columns, got), _rows(rel.columns, rel.fetchall())
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"values {a} != {b}"
    return None
