"""Run registered queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

DRIVER = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in DRIVER.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("n", str(value.normalize() + 0))
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)):
        return ("n", str(decimal.Decimal(repr(value)).normalize() + 0))
    if isinstance(value, (dt.datetime, dt.date)):
        return ("t", value.isoformat())
    return ("s", value)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(plain(row[n]) for n in order) for row in rows)


def difference(frame, con, sql: str) -> tuple[int, str]:
    """Row count of the Spark result, and what differs ('' if nothing)."""
    cursor = con.execute(sql)
    their_columns = [d[0] for d in cursor.description]
    theirs = bag(their_columns, cursor.fetchall())
    ours = bag(frame.columns, frame.collect())
    if sorted(frame.columns) != sorted(their_columns):
        return sum(ours.values()), f"columns {sorted(frame.columns)} vs {sorted(their_columns)}"
    extra, missing = ours - theirs, theirs - ours
    if extra or missing:
        return sum(ours.values()), f"{sum(extra.values())} extra {list(extra)[:2]}, {sum(missing.values())} missing {list(missing)[:2]}"
    return sum(ours.values()), ""
