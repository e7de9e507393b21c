"""Order-insensitive comparison of a Spark result with DuckDB's answer to the SQL counterpart."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _cell(value) -> str:
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, float) and value == int(value):
        return str(int(value))
    return str(value)


def _lines(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    columns = sorted(frame.columns)
    return sorted(zip(*[[_cell(v) for v in frame[c].astype(object)] for c in columns])) if columns else []


def differences(spark_rows: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal and not without rows, else what differs."""
    left = spark_rows.toPandas()
    right = connection.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} vs {sorted(right.columns)}"
    a, b = _lines(left), _lines(right)
    if not a:
        return "no rows"
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""
