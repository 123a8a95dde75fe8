"""Run one catalog query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (Decimal, list, tuple)):
        raise TypeError(f"not a plain result value: {value!r}")
    if isinstance(value, datetime) and value.time() == datetime.min.time():
        return value.date()
    return value


def rows_of(df: DataFrame) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    return columns, Counter(tuple(_plain(v) for v in row) for row in rows)


def duck_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return [names[i] for i in order], rows


_SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                  "boolean": "BOOLEAN", "date": "DATE"}


def type_differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {row[0]: row[1] for row in described}
    return [f"{name}: {kind} vs {duck_types.get(name)}" for name, kind in df.dtypes
            if _SPARK_TO_DUCK.get(kind, kind) != duck_types.get(name)]


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty where both sides agree, else what differs."""
    spark_columns, ours = rows_of(df)
    duck_columns, theirs = duck_rows(connection, sql)
    if spark_columns != duck_columns:
        return f"columns {spark_columns} vs {duck_columns}"
    if ours != theirs:
        return (f"{sum(ours.values())} vs {sum(theirs.values())} rows; "
                f"only ours {list((ours - theirs).items())[:3]}; "
                f"only theirs {list((theirs - ours).items())[:3]}")
    return "; ".join(type_differences(df, connection, sql))
