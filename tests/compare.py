"""Compare a Spark result with DuckDB's answer to a query's SQL counterpart."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _type(field: pa.Field) -> str:
    text = str(field.type).replace("large_", "").replace("string_view", "string")
    return text.replace("timestamp[ns]", "timestamp[us]")


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns, strict=True), key=repr)


def differences(spark_rows: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in schema or in the bag of rows; empty when equal."""
    got, want = spark_rows.toArrow(), con.sql(sql).to_arrow_table()
    found = []
    types = [{f.name: _type(f) for f in t.schema} for t in (got, want)]
    if types[0] != types[1]:
        found.append(f"schema {types[0]} != {types[1]}")
        if types[0].keys() != types[1].keys():
            return found
    left, right = _rows(got), _rows(want)
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)} rows")
    unequal = [(a, b) for a, b in zip(left, right) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found
