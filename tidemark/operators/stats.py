"""Size and usage of every table on every day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import average_whole, day
from tidemark.operators.joins import lookup_join, not_in
from tidemark.sources.fixed_values import (
    COLLECTION_START,
    EXTERNAL_ID,
    EXTERNAL_TABLE,
    INTERNAL_TABLE,
    SIZE_OPEN_END,
)

KEY = ["schema_table", "date"]
# What the rows of the daily table are grouped by.
GROUP = [
    "date", "schema_table", "table_creation_date", "objectsrc", "tablesize_kb", "tbl_rows", "exclude_reason",
    "table_id", "encoded", "diststyle", "sortkey_num", "input_format", "output_format", "parameters",
]


def last_full_day(run_ts: dt.datetime) -> dt.date:
    """The last day whose midnight lies before ``run_ts``."""
    return (run_ts - dt.timedelta(microseconds=1)).date()


def object_lifespan(tables: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """First and last known day per table; open ends count up to today."""
    today = day(run_ts.date())
    return tables.groupBy("schema_table", "schema_name").agg(
        F.min("start_date").alias("fd"),
        F.max(F.when(F.col("end_date") > today, today).otherwise(F.col("end_date"))).alias("ld"),
    )


def _days(first: Column, last: Column) -> Column:
    """The days from ``first`` to ``last``, none if ``last`` comes first (``sequence`` would count down)."""
    return F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>")))


def calendar_spine(
    lifespan: DataFrame, calendar: DataFrame, run_ts: dt.datetime, min_date: dt.date = COLLECTION_START
) -> DataFrame:
    """One row per table and calendar day of its life, after ``min_date`` and before ``run_ts``."""
    first, last = day(min_date + dt.timedelta(days=1)), day(last_full_day(run_ts))
    alive = lifespan.where(F.col("fd").isNotNull() & F.col("ld").isNotNull()).select(
        "schema_table", "schema_name", _days(F.greatest("fd", first), F.least("ld", last)).alias("date")
    )
    return lookup_join(
        alive, calendar.select("date").where(F.col("date").between(first, last)), ["date"]
    )


#: A missing snapshot day as a number; it comes before all others.
NO_DAY = -(2**31)


def _runs(snapshots: DataFrame, key: str, value_cols: list[str], date_col: str) -> DataFrame:
    """A row per run: ``_key``, ``_start`` (a day's number), the key and the values.

    One aggregate packs the days of each (key, values) into a sorted list, another those of each key, which is attached
    once. A day starts a run unless the key's day before it is in the same list. No list is longer than the calendar,
    however many rows a key has, and ``_key`` is what the result is partitioned by.
    """
    days = snapshots.select(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("_key"),
        F.coalesce(F.unix_date(date_col), F.lit(NO_DAY)).alias("_day"),
        key,
        *value_cols,
    )
    packed = days.groupBy("_key", key, *value_cols).agg(F.sort_array(F.collect_set("_day")).alias("_days"))
    whole = days.groupBy("_key").agg(F.sort_array(F.collect_set("_day")).alias("_all"))

    def starts(day_: Column, n: Column) -> Column:
        before = F.get("_all", F.array_position("_all", day_).cast("int") - 2)
        return (n == 0) | (before != F.get("_days", n - 1))

    found = packed.join(whole, "_key").withColumn("_start", F.explode(F.filter("_days", starts)))
    return found.select("_key", "_start", key, *value_cols)


def _date(number: Column) -> Column:
    return F.when(number != NO_DAY, F.date_from_unix_date(number))


def size_islands(
    snapshots: DataFrame, key: str, value_cols: list[str], date_col: str = "snapshot_date"
) -> DataFrame:
    """Runs of consecutive snapshots with equal values: the first day of each run."""
    runs = _runs(snapshots, key, value_cols, date_col)
    return runs.select(_date(F.col("_start")).alias("start_date"), key, *value_cols)


def size_intervals(
    snapshots: DataFrame, value_cols: list[str], key: str = "schema_table", date_col: str = "snapshot_date"
) -> DataFrame:
    """Runs of equal size with their validity, open at the end: ``interval_close`` of ``size_islands``.

    The runs are partitioned by the key already, so the set of its starts costs no further shuffle.
    """
    runs = _runs(snapshots, key, value_cols, date_col)
    starts = F.sort_array(F.collect_set("_start").over(Window.partitionBy("_key")))
    following = F.get("_starts", F.array_position("_starts", F.col("_start")).cast("int"))
    return runs.withColumn("_starts", starts).select(
        _date(F.col("_start")).alias("start_date"),
        key,
        *value_cols,
        F.coalesce(F.date_sub(F.date_from_unix_date(following), 1), day(SIZE_OPEN_END)).alias("end_date"),
    )


def carry_forward(
    spine: DataFrame, changes: dict[str, DataFrame], key: str = "schema_table", date_col: str = "date"
) -> DataFrame:
    """``spine`` (key, day, ..) with an array column per entry of ``changes``: the rows valid on that day.

    ``changes`` are intervals (key, start_date, end_date, further columns). Days and changes of all kinds are partitioned by the
    key once. There, what shares a key and a day becomes one row, with the list of the changes of each kind that start then, and a
    sort per key gives each day the newest list of each kind: a change is in one list, however many others share its start. Nothing
    unfolds into days and no two sides are joined. Intervals of one key may share their start, all of these are carried; such that
    start on different days must not overlap, or the job fails. A key's rows meet in one task: days of the calendar and its changes.
    """
    at = F.unix_date(date_col) * 2
    rows = spine.select(key, (at + 1).alias("_at"), F.struct(*spine.columns).alias("_row"))
    for name, intervals in changes.items():
        carried = [c for c in intervals.columns if c not in (key, "start_date")]
        dated = F.col(key).isNotNull() & F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
        events = intervals.where(dated).select(
            key, (F.unix_date("start_date") * 2).alias("_at"), F.struct(*carried).alias(f"_{name}")
        )
        rows = rows.unionByName(events, allowMissingColumns=True)
    lists = [F.collect_list(f"_{name}").alias(f"_{name}") for name in changes]
    rows = rows.repartition(key).groupBy(key, "_at").agg(F.collect_list("_row").alias("_rows"), *lists)
    by_key = Window.partitionBy(key).orderBy("_at")
    until, before = (by_key.rowsBetween(Window.unboundedPreceding, last) for last in (0, -1))

    def newest(value: Column, name: str, frame) -> Column:
        return F.last(F.when(F.size(f"_{name}") > 0, value), ignorenulls=True).over(frame)

    ends = {name: F.array_max(F.transform(f"_{name}", lambda v: v["end_date"])) for name in changes}
    rows = rows.withColumns({f"_end_{name}": end for name, end in ends.items()})
    rows = rows.withColumns(
        {f"_until_{name}": newest(F.col(f"_{name}"), name, until) for name in changes}
        | {f"_before_{name}": newest(F.col(f"_end_{name}"), name, before) for name in changes}
    )

    is_day = F.col("_at") % 2 == 1
    for name in changes:
        late = (F.size(f"_{name}") > 0) & (F.unix_date(f"_before_{name}") * 2 >= F.col("_at"))
        refused = F.raise_error(F.concat(F.lit(f"intervals of {name} overlap: "), F.col(key))).cast("boolean")
        is_day = F.when(late, refused).otherwise(is_day)
    days = rows.where(is_day).select(key, F.explode("_rows").alias("_row"), *[f"_until_{name}" for name in changes])
    days = days.withColumns({c: F.col(f"_row.{c}") for c in spine.columns if c != key})  # the key stays what rows are partitioned by
    valid = {name: F.filter(f"_until_{name}", lambda v: v["end_date"] >= F.col(date_col)) for name in changes}
    return days.withColumns(valid).select(*spine.columns, *changes)


def asof_scd_join(spine: DataFrame, tables: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The version of each table that was valid on each day of the spine, with the columns ``also``."""
    found = carry_forward(spine, {"version": _attributes(tables, also)})
    return _unfolded(found, "version", F.explode)


def _unfolded(rows: DataFrame, name: str, explode, names: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with the fields of the array column ``name``, without the end of their validity."""
    fields = rows.schema[name].dataType.elementType.names
    others = [c for c in rows.columns if c != name]
    out = rows.select(*others, explode(name).alias("_v"))
    return out.select(*others, *[F.col(f"_v.{f}").alias((names or {}).get(f, f)) for f in fields if f != "end_date"])


def _attributes(tables: DataFrame, also: tuple[str, ...]) -> DataFrame:
    return tables.select(
        *also,
        "start_date",
        "end_date",
        "schema_table",
        F.to_date("table_creation_time").alias("table_creation_date"),
        "objectsrc",
        F.coalesce("table_id", F.lit(EXTERNAL_ID)).alias("table_id"),
        "encoded",
        "diststyle",
        "sortkey_num",
        "input_format",
        "output_format",
        "parameters",
    )


def _sizes(internal_intervals: DataFrame, external_intervals: DataFrame) -> dict[str, DataFrame]:
    return {
        "inside": internal_intervals.select("schema_table", "start_date", "end_date", F.col("tablesize_kb").cast("double"), "tbl_rows"),
        "outside": external_intervals.select("schema_table", "start_date", "end_date", F.col("tablesize_kb").cast("double")),
    }


def _with_sizes(rows: DataFrame) -> DataFrame:
    """``rows`` with the arrays ``inside`` and ``outside`` unfolded into the size known on the day."""
    rows = _unfolded(rows, "inside", F.explode_outer, {"tablesize_kb": "_internal_kb"})
    rows = _unfolded(rows, "outside", F.explode_outer, {"tablesize_kb": "_external_kb"})
    return rows.withColumn("tablesize_kb", F.coalesce("_internal_kb", "_external_kb")).drop("_internal_kb", "_external_kb")


def forward_fill_sizes(spine: DataFrame, internal_intervals: DataFrame, external_intervals: DataFrame) -> DataFrame:
    """The size known on each day of the spine; NULL before the first snapshot."""
    return _with_sizes(carry_forward(spine, _sizes(internal_intervals, external_intervals)))


def daily_usage(query_deps: DataFrame) -> DataFrame:
    """Usage per table and day of start.

    A pair of table and query occurs once (``query_dependencies``), so queries are counted, and users are the rows of a first
    aggregate by table, day and user. Its sums are whole numbers, so nothing depends on their order.
    """
    by_user = (
        query_deps.select(
            "schema_table", F.to_date("starttime").alias("date"), "query_id", "usename", "aborted", "duration_second"
        )
        .groupBy(*KEY, "usename")
        .agg(
            F.count("query_id").alias("queries"),
            F.sum("aborted").alias("aborted"),
            F.min("duration_second").alias("shortest"),
            F.max("duration_second").alias("longest"),
            F.sum("duration_second").alias("seconds"),
            F.count("duration_second").alias("timed"),
        )
    )
    return by_user.groupBy(*KEY).agg(
        F.sum("queries").alias("cnt_query"),
        F.count("usename").alias("cntd_usename"),
        F.sum("aborted").alias("sum_aborted"),
        F.min("shortest").alias("min_query_duration_sec"),
        F.max("longest").alias("max_query_duration_sec"),
        average_whole(F.sum("seconds"), F.sum("timed")).alias("avg_query_duration_sec"),
    )


def daily_usage_join(spine: DataFrame, query_deps: DataFrame, repeats: str | None = None) -> DataFrame:
    """The spine with each day's usage, 0 on days without queries.

    ``repeats`` names a column that says how often the spine row stands for itself: each repeat
    adds the aborted queries again; counts of distinct values, extremes and the average do not
    change.
    """
    usage = daily_usage(query_deps)
    measures = [c for c in usage.columns if c not in KEY]
    joined = spine.join(usage, KEY, "left")
    filled = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in measures}
    if repeats:
        filled["sum_aborted"] = filled["sum_aborted"] * F.col(repeats)
    return joined.withColumns(filled)


def size_excludes_latest(excludes: DataFrame, external_space: DataFrame) -> DataFrame:
    """The newest reasons why an external table has no size; tables that have one drop out."""
    open_ = not_in(excludes, external_space, "schema_table")
    newest = F.max("created_at").over(Window.partitionBy("schema_table"))
    return open_.withColumn("_newest", newest).where(F.col("created_at") == F.col("_newest")).select("schema_table", "exclude_reason")


def table_stats_byday(
    tables: DataFrame,
    query_deps: DataFrame,
    internal_space: DataFrame,
    external_space: DataFrame,
    excludes: DataFrame,
    calendar: DataFrame,
    run_ts: dt.datetime,
    min_date: dt.date = COLLECTION_START,
) -> DataFrame:
    """Size, attributes and usage of every table on every day.

    The queries are summed up per table and day before they meet the spine. Spine rows that fall
    into one group (a table with two equal exclusion reasons, say) are counted first, because
    the sum of aborted queries counts a query once for each of them. Versions and sizes of both kinds reach the
    days of a table in one sweep, whose partitioning also serves the grouping.
    """
    reasons = size_excludes_latest(excludes, external_space)
    reasons = reasons.groupBy("schema_table", "exclude_reason").agg(F.count(F.lit(1)).alias("reasons"))
    versions = _attributes(tables.join(reasons, "schema_table", "left"), ("exclude_reason", "reasons"))
    spine = calendar_spine(object_lifespan(tables, run_ts), calendar, run_ts, min_date).select("schema_table", "date")
    sizes = _sizes(size_intervals(internal_space, ["tablesize_kb", "tbl_rows"]), size_intervals(external_space, ["tablesize_kb"]))
    sized = _with_sizes(_unfolded(carry_forward(spine, {"version": versions} | sizes), "version", F.explode))
    grouped = sized.groupBy(*GROUP).agg(F.sum(F.coalesce("reasons", F.lit(1))).alias("_repeats"))
    used = daily_usage_join(grouped, query_deps, "_repeats")
    return used.select(
        F.col("date").alias("snapshot_date"),
        "schema_table",
        "table_creation_date",
        "objectsrc",
        "tablesize_kb",
        (F.col("tbl_rows") * F.lit("1.0").cast("decimal(2,1)") / F.lit(1000000)).cast("decimal(38,4)").alias("tbl_rows_mm"),
        "cnt_query",
        "cntd_usename",
        "sum_aborted",
        "min_query_duration_sec",
        "max_query_duration_sec",
        "avg_query_duration_sec",
        F.col("exclude_reason").alias("size_exclude_reason"),
        "table_id",
        "encoded",
        "diststyle",
        "sortkey_num",
        "input_format",
        "output_format",
        "parameters",
    )


def data_lake_stats_byday(table_stats: DataFrame) -> DataFrame:
    """Totals per day: tables, sizes, durations and the share of aborted queries, by source."""
    inside, outside = F.col("objectsrc") == INTERNAL_TABLE, F.col("objectsrc") == EXTERNAL_TABLE

    def tables(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    def gigabytes(condition: Column) -> Column:
        return F.round(F.sum(F.when(condition, F.col("tablesize_kb") / 1024.0 / 1024.0).otherwise(0.0)), 0)

    def duration(condition: Column) -> Column:
        seconds = F.when(condition, F.col("avg_query_duration_sec"))
        return average_whole(F.sum(seconds), F.count(seconds))

    def aborted_share(condition: Column) -> Column:
        aborted = F.sum(F.when(condition, F.col("sum_aborted"))).cast("decimal(19,0)")
        return F.try_divide(aborted, F.sum(F.when(condition, F.col("cnt_query")))).cast("decimal(18,6)")

    return table_stats.groupBy("snapshot_date").agg(
        tables(inside).alias("table_count_internal"),
        tables(outside).alias("table_count_spectrum"),
        tables(outside & F.col("size_exclude_reason").isNotNull()).alias("table_count_spectrum_no_size"),
        gigabytes(inside).alias("size_gb_internal"),
        gigabytes(outside).alias("size_gb_spectrum"),
        duration(inside).alias("avg_query_duration_sec_internal"),
        duration(outside).alias("avg_query_duration_sec_external"),
        aborted_share(inside).alias("pct_queries_aborted_internal"),
        aborted_share(outside).alias("pct_queries_aborted_external"),
    )
