"""Compare a Spark result with DuckDB's: same columns, same rows in any order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def spark_rows(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(row[c] for c in columns) for row in df.collect())


def duckdb_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in result.fetchall())
