"""Run a query and its SQL side by side and report differences."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sort_key(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(spark_df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    columns = sorted(spark_df.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} vs {sorted(relation.columns)}"]
    found = []
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind, kind) != theirs[name]:
            found.append(f"type of {name}: {kind} vs {theirs[name]}")
    ours = sorted((tuple(_plain(v) for v in r) for r in spark_df.select(*columns).collect()), key=_sort_key)
    names = ", ".join(f'"{c}"' for c in columns)
    rows = con.sql(f"SELECT {names} FROM ({sql})").fetchall()
    rows = sorted((tuple(_plain(v) for v in r) for r in rows), key=_sort_key)
    if len(ours) != len(rows):
        found.append(f"rows {len(ours)} vs {len(rows)}")
    bad = [(a, b) for a, b in zip(ours, rows) if a != b]
    if bad:
        found.append(f"{len(bad)} rows differ, first {columns}: {bad[0]}")
    return found
