"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if value is None or isinstance(value, dt.date) else value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    rows = [tuple(r) for r in frame.collect()]
    return sorted(frame.columns), normal(frame.columns, rows)


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), normal(columns, cursor.fetchall())


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(frame, con, sql: str) -> list[str]:
    """Columns whose Spark type has no equal DuckDB type."""
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    found = []
    for name, kind in frame.dtypes:
        expected = SPARK_TO_DUCK.get(kind, kind.upper())
        if described.get(name) != expected:
            found.append(f"{name}: {kind} against {described.get(name)}")
    return found
