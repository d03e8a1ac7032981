"""Daily size snapshots of internal and external tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import day, kb_to_gb, local_day, moment, qualified
from tidemark.operators.ingest import high_water_mark
from tidemark.operators.joins import lookup_join
from tidemark.sources.fixed_values import (
    EXTERNAL_ID,
    EXTERNAL_SPACE,
    FIRST_STAGED_DAY,
    INTERNAL_SPACE,
    SNAPSHOT_ZONE,
)


def internal_snapshot(source: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Today's sizes of all internal tables; the source counts megabytes. Names stay as they are."""
    return source.select(
        day(run_ts.date()).alias("snapshot_date"),
        F.col("table_id").cast("int").alias("table_id"),
        qualified(F.col("schema"), F.col("table")).alias("schema_table"),
        (F.col("size") * F.lit(1024)).cast("decimal(25,1)").alias("tablesize_kb"),
        "pct_used",
        "empty",
        "unsorted",
        "stats_off",
        "tbl_rows",
        "skew_sortkey1",
        "skew_rows",
        "estimated_visible_rows",
        "risk_event",
        "vacuum_sort_benefit",
        moment(run_ts).alias("created_at"),
    )


def holds_today_last(stored: DataFrame, run_date: dt.date) -> bool:
    """Whether the newest stored snapshot is today's, so that a new one takes its place."""
    return high_water_mark(stored, "snapshot_date").first()["last_snapshot_date"] == run_date


def snapshot_replace_day(stored: DataFrame, source: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """All snapshots after today's run. Stored rows of today go only if today is the newest stored day."""
    run_date = run_ts.date()
    if holds_today_last(stored, run_date):
        stored = stored.where(~F.col("snapshot_date").eqNullSafe(day(run_date)))
    return stored.unionByName(internal_snapshot(source, run_ts))


def space_stage(
    stage: DataFrame, tz: str = SNAPSHOT_ZONE, min_date: dt.date = FIRST_STAGED_DAY
) -> DataFrame:
    """External sizes by local day. The cut at ``min_date`` goes by the UTC day of the same column."""
    recent = stage.where(F.col("created_at") >= moment(dt.datetime.combine(min_date, dt.time())))
    return recent.select(
        local_day("created_at", tz).alias("snapshot_date"),
        F.lit(EXTERNAL_ID).alias("table_id"),
        "schema_table",
        "tablesize_kb",
    )


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str], day_col: str = "snapshot_date") -> DataFrame:
    """The rows whose key is not in ``target`` yet. Rows that share a key with each other all stay.

    Only the days of the batch are read from ``target``, which is partitioned by ``day_col``, one of the keys.
    """
    days = rows.agg(F.min(day_col).alias("first"), F.max(day_col).alias("last")).first()
    if days["first"] is None:
        return rows
    stored = target.where(F.col(day_col).between(day(days["first"]), day(days["last"])))
    return rows.join(stored.select(*keys), keys, "left_anti")


def table_space(internal_space: DataFrame, external_space: DataFrame) -> DataFrame:
    """All snapshots in gigabytes, with a flag on the newest one of each table.

    Newest by ``table_id`` for internal tables and by name for external ones.
    """

    def flagged(space: DataFrame, key: str, source: str) -> DataFrame:
        newest = (
            space.groupBy(key)
            .agg(F.max("snapshot_date").alias("snapshot_date"))
            .withColumn("_newest", F.lit(1))
        )
        # one row per table, so a broadcast or a plain shuffle; measuring it would scan all snapshots once more
        rows = space if "tbl_rows" in space.columns else space.withColumn("tbl_rows", F.lit(None).cast("decimal(38,0)"))
        return rows.join(newest, [key, "snapshot_date"], "left").select(
            "snapshot_date",
            "table_id",
            "schema_table",
            F.lit(source).alias("objectsrc"),
            kb_to_gb("tablesize_kb").alias("tablesize_gb"),
            "tbl_rows",
            F.coalesce("_newest", F.lit(0)).alias("last_snd_flag"),
        )

    return flagged(internal_space, "table_id", INTERNAL_SPACE).unionByName(
        flagged(external_space, "schema_table", EXTERNAL_SPACE)
    )
