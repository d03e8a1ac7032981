"""Type-2 history of table attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import day, moment
from tidemark.operators.checks import require_unique
from tidemark.operators.joins import lookup_join, not_in
from tidemark.sources.contracts import TABLE_ATTRIBUTES
from tidemark.sources.fixed_values import OPEN_END


def changed_rows(incoming: DataFrame, current: DataFrame, attrs: list[str]) -> DataFrame:
    """Distinct incoming rows that differ from every current version in some attribute; NULL equals NULL."""
    return incoming.select(*attrs).subtract(current.where("most_recent").select(*attrs))


def scd2_apply(
    current: DataFrame,
    incoming: DataFrame,
    run_date: dt.date,
    run_ts: dt.datetime | None = None,
    close_by: str = "table_id",
    sticky_close: bool = False,
) -> DataFrame:
    """The history after a run on ``run_date`` that saw the catalog ``incoming``.

    New and changed tables get a version that starts on ``run_date``, in place of a version from
    the same day. A table whose ``close_by`` value is gone from the catalog ends on ``run_date``
    and stays the most recent version; the end moves on with each run unless ``sticky_close``.
    """
    require_unique(incoming, "schema_table", "incoming catalog")
    latest = current.agg(F.max("start_date")).first()[0]
    if latest is not None and latest > run_date:
        raise ValueError(f"run date {run_date} lies before the stored start date {latest}")

    changed = changed_rows(incoming, current, TABLE_ATTRIBUTES)
    replaced = changed.select("schema_table", day(run_date).alias("start_date"))
    kept = current.join(replaced, ["schema_table", "start_date"], "left_anti")
    stamp = moment(run_ts or dt.datetime.combine(run_date, dt.time()))
    opened = changed.select(
        day(run_date).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        *TABLE_ATTRIBUTES,
        stamp.alias("created_at"),
    )
    versions = kept.drop("most_recent").unionByName(opened)

    # (schema_table, start_date) is unique: a name has at most one row per day of history.
    following = F.lead("start_date").over(Window.partitionBy("schema_table").orderBy("start_date"))
    dated = versions.withColumn("_next", following)
    gone = not_in(current.select(close_by).distinct(), incoming, close_by).withColumn("_gone", F.lit(True))
    dated = lookup_join(dated, gone, [close_by], "left", null_safe=True)
    already = (F.col("end_date") < day(OPEN_END)) if sticky_close else F.lit(False)
    end = (
        F.when(F.col("_next").isNotNull(), F.date_sub("_next", 1))
        .when(F.col("_gone") & already, F.col("end_date"))
        .when(F.col("_gone"), day(run_date))
        .otherwise(day(OPEN_END))
    )
    return dated.select(
        "start_date",
        end.alias("end_date"),
        F.col("_next").isNull().alias("most_recent"),
        *TABLE_ATTRIBUTES,
        "created_at",
    )


def interval_close(df: DataFrame, key: str, start_col: str, open_end: dt.date, end_col: str = "end_date") -> DataFrame:
    """Add ``end_col``: the day before the key's next later start, or ``open_end``.

    Rows that share a start share its end. The starts of a key are a set that no number of rows makes longer than the
    calendar; a row's end is read from what follows its start in it, so ``df`` is evaluated and shuffled once.
    """
    number = F.unix_date(start_col)  # a row without a start comes first, so the first start closes it
    starts = F.sort_array(F.collect_set(number).over(Window.partitionBy(key)))
    following = F.get("_starts", F.coalesce(F.array_position("_starts", number), F.lit(0)).cast("int"))
    end = F.coalesce(F.date_sub(F.date_from_unix_date(following), 1), day(open_end))
    return df.withColumn("_starts", starts).withColumn(end_col, end).drop("_starts")


def history_lookup(tables: DataFrame, schema_table: str) -> DataFrame:
    """All versions of one table, oldest first."""
    return (
        tables.where(F.col("schema_table") == schema_table)
        .select("start_date", "end_date", "most_recent", "schema_table", "table_id", "objectsrc", "parameters")
        .orderBy("start_date")
    )
