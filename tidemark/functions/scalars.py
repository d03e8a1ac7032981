"""Column expressions whose plain Spark spelling would give a different result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: dt.datetime) -> Column:
    """A zone-free timestamp literal; ``F.lit(datetime)`` would carry the session time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day(value: dt.date) -> Column:
    return F.lit(value)


def _whole_seconds(ts: Column) -> Column:
    since = ts - F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return since.cast("interval second").cast("bigint")


def seconds_between(start: str, end: str) -> Column:
    """Second boundaries crossed from ``start`` to ``end``: 0.9 s to 1.1 s counts as 1.

    ``timestampdiff`` counts elapsed seconds, and ``unix_timestamp`` depends on the session time
    zone. Interval arithmetic does neither.
    """
    return _whole_seconds(F.col(end)) - _whole_seconds(F.col(start))


def qualified(schema: Column, name: Column) -> Column:
    """``schema.name``; NULL if either part is NULL."""
    return F.concat(schema, F.lit("."), name)


def local_day(ts: str, tz: str) -> Column:
    """The calendar day in ``tz`` of a UTC timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts)))


def average_whole(total: Column, count: Column) -> Column:
    """Average of whole numbers, cut to a whole number; NULL over no rows."""
    return F.call_function("div", total, F.nullif(count, F.lit(0)))


def kb_to_gb(kb: str) -> Column:
    return (F.col(kb).cast("decimal(25,1)") / F.lit(1024 * 1024)).cast("decimal(18,2)")
