"""Runs a query on Spark and its SQL on DuckDB and compares the rows exactly."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

KINDS = {
    "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "double": "float64", "float": "float32",
    "string": "text", "boolean": "bool", "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamp",
    "TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "FLOAT": "float32",
    "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp", "HUGEINT": "int128",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and v == 0:
        return 0.0
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    rel = con.sql(sql)
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    names = sorted(ours)
    for n in names:
        a, b = KINDS.get(ours[n], ours[n]), KINDS.get(theirs[n], theirs[n])
        if a != b and theirs[n] != '"NULL"':
            return f"type of {n}: {ours[n]} != {theirs[n]}"
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    left = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=key)
    right_cols = [rel.columns.index(n) for n in names]
    right = sorted((tuple(_plain(r[i]) for i in right_cols) for r in rel.fetchall()), key=key)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"first difference on {names}: {a} != {b}"
    return None
