"""Run a registered query and its SQL, and compare columns, types and values."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def differences(df, con, sql) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _sorted_rows(names, result.fetchall())
    types = {r[0]: DUCK_TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    found = []
    if dict(df.dtypes) != types:
        found.append(f"types: spark {sorted(set(df.dtypes) - set(types.items()))} sql {sorted(set(types.items()) - set(df.dtypes))}")
    ours = spark_rows(df)
    if len(ours) != len(theirs):
        found.append(f"rows: spark {len(ours)} sql {len(theirs)}")
    if ours != theirs:
        found.append("values: " + "; ".join(f"{a} <> {b}" for a, b in list(zip(ours, theirs)) if a != b)[:900])
    if not ours:
        found.append("no rows")
    return found
