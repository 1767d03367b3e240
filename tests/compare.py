"""Spark against DuckDB: row count, columns, and values as an unordered bag of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6) + 0.0
    return x


KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty when both sides agree."""
    columns = sorted(df.columns)
    relation = con.sql(sql)
    names = sorted(relation.columns)
    if columns != names:
        return [f"columns {columns} != {names}"]
    out = []
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in df.dtypes:
        if KINDS.get(kind) != kinds[name]:
            out.append(f"type of {name}: {kind} != {kinds[name]}")
    at = [df.columns.index(c) for c in columns]
    ours = Counter(tuple(cell(r[i]) for i in at) for r in df.collect())
    at = [relation.columns.index(c) for c in columns]
    theirs = Counter(tuple(cell(r[i]) for i in at) for r in relation.fetchall())
    if ours != theirs:
        out.append(f"rows {sum(ours.values())} / {sum(theirs.values())}")
        out.append(f"only here {list((ours - theirs).items())[:3]}")
        out.append(f"only in the oracle {list((theirs - ours).items())[:3]}")
    return out
