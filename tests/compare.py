"""Compare a Spark frame with the rows DuckDB gives for SQL on the same files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

DUCK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "FLOAT": "float", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _value(v):
    return round(v, 4) if isinstance(v, float) and not math.isnan(v) else v


def _bag(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=_key)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types and rows; empty if nothing does."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected = {r[0]: DUCK_TYPES.get(r[1], r[1]) for r in described}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = [f"{c}: {found.get(c)} is not {expected.get(c)}" for c in found.keys() | expected.keys() if found.get(c) != expected.get(c)]
    if found.keys() != expected.keys():
        return problems
    got = _bag(df.collect(), list(found))
    want = _bag(con.execute(sql).fetchall(), [r[0] for r in described])
    if len(got) != len(want):
        problems.append(f"{len(got)} rows, expected {len(want)}")
    elif got != want:
        first = next((g, w) for g, w in zip(got, want) if g != w)
        problems.append(f"rows differ, first: {first}")
    return problems
