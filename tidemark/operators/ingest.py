"""Incremental load of the query log, and searches over it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import moment, seconds_between
from tidemark.operators.joins import lookup_join
from tidemark.operators.numbering import global_row_number
from tidemark.session import durable
from tidemark.sources.fixed_values import BEGINNING, UNKNOWN_USER

LOG_COLUMNS = ["userid", "querytxt", "starttime", "endtime", "aborted"]


def high_water_mark(target: DataFrame, ts_col: str, id_col: str | None = None) -> DataFrame:
    """One row: the newest ``ts_col`` and the largest ``id_col`` stored, or the defaults for an empty target."""
    beginning = moment(BEGINNING).cast(target.schema[ts_col].dataType)
    marks = [F.coalesce(F.max(ts_col), beginning).alias(f"last_{ts_col}")]
    if id_col:
        marks.append(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias(f"max_{id_col}"))
    return target.agg(*marks)


def ingest_incremental(
    log: DataFrame, users: DataFrame, target: DataFrame, run_ts: dt.datetime, history: DataFrame | None = None
) -> DataFrame:
    """The rows to append to ``target``: log entries that start after its newest entry.

    Entries that tie with the newest stored start, or come late, are not loaded. With an archived
    log in ``history`` the two are merged and duplicates removed.
    """
    mark = high_water_mark(target, "starttime", "query_id").first()
    newer = F.col("starttime") > moment(mark["last_starttime"])
    entries = log.select(*LOG_COLUMNS).where(newer)
    if history is not None:
        entries = durable(entries.unionByName(history.select(*LOG_COLUMNS).where(newer)).distinct())
    numbered = global_row_number(
        entries, ["starttime", "endtime", "userid", "querytxt", "aborted"], mark["max_query_id"]
    )
    people = users.select(F.col("usesysid").alias("userid"), "usename")
    named = lookup_join(numbered, people, ["userid"], "left")
    return named.select(
        "query_id",
        "userid",
        "querytxt",
        F.coalesce("usename", F.lit(UNKNOWN_USER)).alias("usename"),
        seconds_between("starttime", "endtime").alias("duration_second"),
        "starttime",
        "endtime",
        "aborted",
        moment(run_ts).alias("created_at"),
    )


def query_search(queries: DataFrame, needle: str, min_seconds: int) -> DataFrame:
    """Queries whose text holds ``needle`` and that ran longer than ``min_seconds``, by start time.

    The further sort columns let a start time shared by many queries spread over several tasks.
    """
    return (
        queries.where(F.col("querytxt").contains(needle) & (F.col("duration_second") > min_seconds))
        .select("starttime", "duration_second", "usename", "aborted", "querytxt")
        .orderBy("starttime", "duration_second", "usename", "aborted")
    )
