"""Compare a named query with its SQL text in DuckDB, value by value."""

from __future__ import annotations

import glob
import math
import os

import duckdb

SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return "0.0"
    return repr(value)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences as messages; empty when names, types and rows agree."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = [str(d[1]) for d in rel.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    problems = []
    spark_kinds = dict(df.dtypes)
    for name, kind in zip(names, kinds):
        if SPARK_TYPES.get(kind, kind) != spark_kinds[name]:
            problems.append(f"type of {name}: {spark_kinds[name]} against {kind}")
    order = sorted(names)
    theirs = [dict(zip(names, r)) for r in rel.fetchall()]
    ours = [r.asDict() for r in df.collect()]
    a = sorted(tuple(plain(r[n]) for n in order) for r in ours)
    b = sorted(tuple(plain(r[n]) for n in order) for r in theirs)
    if a != b:
        only_a = sorted(set(a) - set(b))[:3]
        only_b = sorted(set(b) - set(a))[:3]
        problems.append(f"{len(a)} rows against {len(b)}; only ours {str(only_a)[:900]}; only theirs {str(only_b)[:900]}")
    return problems
