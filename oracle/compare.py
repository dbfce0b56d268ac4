"""Compare a Spark result with a DuckDB result: names, row count and every value."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
          "TIMESTAMP": "timestamp_ntz", "DATE": "date"}


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    other = {f.name: f.dataType.simpleString() for f in df.schema if kinds[f.name] != f.dataType.simpleString()}
    if other:
        return f"types {other} against { {n: kinds[n] for n in other} }"
    ours, theirs = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(names, result.fetchall())
    if ours != theirs:
        return (
            f"{ours.total()} rows against {theirs.total()};"
            f" only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
        )
    return None
