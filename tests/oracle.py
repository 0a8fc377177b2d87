"""Compare a Spark result with DuckDB's result for the oracle SQL."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"  # equal to itself, unlike the number
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def difference(df, sql: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """What differs, or None if rows, names and types agree."""
    result = connection.execute(sql)
    wanted_types = {c[0]: str(c[1]) for c in result.description}
    wanted = _multiset(list(wanted_types), result.fetchall())
    types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    if types != wanted_types:
        return f"types: got {types}, want {wanted_types}"
    got = _multiset(df.columns, df.collect())
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        return (
            f"{sum(got.values())} rows, want {sum(wanted.values())}; "
            f"extra {list(extra.items())[:3]}, missing {list(missing.items())[:3]}"
        )
    return None
