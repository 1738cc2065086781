"""Runs a catalogue query in Spark and its SQL in DuckDB, and compares schema and rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import datetime

import duckdb

_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v: object) -> object:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    relation = con.sql(sql)
    expected = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    actual = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    actual = {c: ("VARCHAR" if t.startswith("varchar") else t) for c, t in actual.items()}
    if sorted(expected) != sorted(actual):
        return f"columns {sorted(actual)} instead of {sorted(expected)}"
    mine, theirs = _rows(df.columns, df.collect()), _rows(list(relation.columns), relation.fetchall())
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        return f"{sum(mine.values())} rows for {sum(theirs.values())}; extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    # A column of nothing but NULL has an accidental type in SQL.
    wrong = {c: (t, expected[c]) for c, t in actual.items() if t != expected[c] and '"NULL"' != expected[c]}
    return f"types {wrong}" if wrong else None
