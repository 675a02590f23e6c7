"""Compare a query with its SQL over the same parquet files."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("n", float(value))
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("n", float(f"{value:.12g}"))
    if isinstance(value, dt.datetime):
        return ("t", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("t", dt.datetime(value.year, value.month, value.day).isoformat())
    return ("s", value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


KINDS = {"bigint": "int64", "int": "int32", "smallint": "int16", "double": "double",
         "string": "varchar", "boolean": "boolean", "date": "date"}
DUCK = {"BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "DOUBLE": "double",
        "VARCHAR": "varchar", "BOOLEAN": "boolean", "DATE": "date"}


def difference(df, con, sql: str) -> str | None:
    """What differs, or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = rows_of(names, cursor.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if len(actual[1]) != len(expected[1]):
        return f"{len(actual[1])} rows != {len(expected[1])}"
    bad = [(a, e) for a, e in zip(actual[1], expected[1]) if a != e]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]} in {actual[0]}"
    loose = [
        f"{c}: {t} vs {duck_types[c]}" for c, t in df.dtypes
        if KINDS.get(t, t) != DUCK.get(duck_types[c], duck_types[c])
        and not t.startswith("timestamp")
    ]
    return f"TYPES {loose}" if loose else None
