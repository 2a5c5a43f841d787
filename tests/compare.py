"""Compare a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if value is None or isinstance(value, (bool, int, str, dt.date)):
        return value
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    return float(value) if value == value else "nan"


def rows_by_name(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None when columns, row counts and values agree, else a short account."""
    names = df.columns
    got_rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns differ: {sorted(set(names) ^ set(want_names))}"
    if len(got_rows) != len(want_rows):
        return f"rows differ: {len(got_rows)} against {len(want_rows)}"
    got, want = rows_by_name(names, got_rows), rows_by_name(want_names, want_rows)
    if got != want:
        only_got, only_want = sorted((got - want).elements()), sorted((want - got).elements())
        cells = [
            (name, a, b)
            for name, a, b in zip(sorted(names), only_got[0], only_want[0], strict=True)
            if a != b
        ]
        return f"{len(only_got)} rows differ, first: {cells[:6]}"
    return None
