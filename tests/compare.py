"""Order-insensitive comparison of a Spark result with DuckDB."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain_value(value):
    if isinstance(value, datetime):
        return value.isoformat(" ", "microseconds")
    if isinstance(value, date):
        return value.isoformat()
    return value


def differences(spark_df, connection, sql: str) -> list[str]:
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"]
    wanted = Counter(tuple(map(plain_value, row)) for row in found.fetchall())
    rows = spark_df.select(*(f"`{n}`" for n in names)).collect()
    got = Counter(tuple(map(plain_value, row)) for row in rows)
    out = [f"only in Spark: {row}" for row in list((got - wanted).elements())[:3]]
    out += [f"only in SQL: {row}" for row in list((wanted - got).elements())[:3]]
    return out
