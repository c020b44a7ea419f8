"""Order-insensitive comparison of a Spark result with DuckDB SQL over the same files."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def _rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(t[i]) for i in order) for t in tuples])


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs first."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected_types = {d[0]: str(d[1]) for d in cur.description}
    expected = _rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns: only Spark {set(df.columns) - set(names)}, only SQL {set(names) - set(df.columns)}"
    loose = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
             "DATE": "date", "TIMESTAMP": "timestamp"}
    for name, kind in df.dtypes:
        if loose.get(expected_types[name]) != kind:
            return f"type of {name}: Spark {kind}, SQL {expected_types[name]}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"rows: Spark {len(got)}, SQL {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            both = [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]
            bad = sum(1 for p, q in zip(got, expected) if p != q)
            return f"{bad} of {len(got)} rows; first: {both[:4]} in {a[:3]}"
    return None
