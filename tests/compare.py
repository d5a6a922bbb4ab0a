"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _value(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value)
    if hasattr(value, "as_tuple"):
        return f"decimal {value}"
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda place: names[place])
    return Counter(tuple(_value(row[place]) for place in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as text; an empty list when all agree."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    ours = _rows(df.columns, [tuple(row) for row in df.toLocalIterator()])
    theirs = _rows(names, result.fetchall())
    found = []
    if not ours:
        found.append("no rows")
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        found.append(f"{ours.total()} rows against {theirs.total()}")
        found.append(f"only in Spark {only_ours.total()}: {list(only_ours)[:3]}")
        found.append(f"only in SQL {only_theirs.total()}: {list(only_theirs)[:3]}")
    return found
