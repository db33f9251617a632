"""Side-by-side check of the Spark queries against their SQL text in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb

NUMBER_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR",
                "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)  # one zero
    return repr(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """Empty when columns, types, row count and every value agree."""
    result = con.sql(sql)
    problems = []
    expected_types = {c: str(t) for c, t in zip(result.columns, result.types)}
    got_types = {name: NUMBER_TYPES.get(kind, kind) for name, kind in df.dtypes}
    if got_types != expected_types:
        problems.append(f"types {sorted(set(got_types.items()) ^ set(expected_types.items()))}")
    columns, rows = _table(df.columns, [tuple(r) for r in df.collect()])
    expected_columns, expected = _table(result.columns, result.fetchall())
    if columns != expected_columns:
        return problems + [f"columns {columns} != {expected_columns}"]
    if len(rows) != len(expected):
        problems.append(f"{len(rows)} rows, expected {len(expected)}")
    if rows != expected:
        ours, theirs = sorted(set(rows) - set(expected)), sorted(set(expected) - set(rows))
        problems.append(f"{len(ours)} differing rows of {columns}")
        problems += [f"  spark {a}\n  sql   {b}" for a, b in list(zip(ours, theirs))[:limit]]
    return problems
