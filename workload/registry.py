"""The registered queries: each runs one operator over inputs derived from the driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import day, moment
from tidemark.operators import catalog, checks, grams, ingest, matching, numbering, scd, space, stats
from tidemark.operators import dependencies as deps
from tidemark.plans import new_state, read_state, run_all, store_run
from tidemark.session import checkpoint_root, durable, intermediates
from tidemark.sources import TABLE_ATTRIBUTES, TARGETS, empty_target, read_target
from workload.inputs import Inputs

RUN_TS = dt.datetime(2024, 1, 30, 23, 59, 59, 999999)  # after the last event
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 16), dt.date(2024, 1, 30)]
FIRST_RUN = dt.datetime(2024, 1, 15, 12)
FIRST_BATCH = dt.datetime(2024, 1, 16)
STORED_UNTIL = dt.date(2024, 1, 20)
LOG_ORDER = ["starttime", "endtime", "userid", "querytxt", "aborted"]
INTERNAL_VALUES = ["tablesize_kb", "tbl_rows"]

Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


def renamed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"raw_table": "table", "raw_schema": "schema"})


# --- query log ------------------------------------------------------------------------------------


@query
def q_high_water_mark(i: Inputs) -> DataFrame:
    return ingest.high_water_mark(i["sql_queries"], "starttime", "query_id")


@query
def q_ingest_incremental(i: Inputs) -> DataFrame:
    stored = i["sql_queries"].where(F.col("created_at") == moment(FIRST_BATCH))
    return ingest.ingest_incremental(i["query_log"], i["users"], stored, RUN_TS, i["log_archive"])


@query
def q_global_row_number(i: Inputs) -> DataFrame:
    return numbering.global_row_number(i["query_log"], LOG_ORDER)


@query
def q_query_search(i: Inputs) -> DataFrame:
    return ingest.query_search(i["sql_queries"], "STANDARD.Brand#1", 20)


@query
def q_load_audit(i: Inputs) -> DataFrame:
    return checks.load_audit(i["sql_queries"])


@query
def q_preview(i: Inputs) -> DataFrame:
    return checks.preview(i["sql_queries"], 100, ["starttime", "query_id"])


# --- catalog and history --------------------------------------------------------------------------


@query
def q_catalog_filter(i: Inputs) -> DataFrame:
    return catalog.catalog_filter(renamed(i["internal_raw"]), "schema")


@query
def q_table_creation_times(i: Inputs) -> DataFrame:
    return catalog.table_creation_times(i["class_info"], i["pg_namespace"])


@query
def q_catalog_union(i: Inputs) -> DataFrame:
    times = catalog.table_creation_times(i["class_info"], i["pg_namespace"])
    return catalog.catalog_union(renamed(i["internal_raw"]), times, i["external_tables"])


@query
def q_changed_rows(i: Inputs) -> DataFrame:
    return scd.changed_rows(i["catalog"], i["tables"], TABLE_ATTRIBUTES)


@query
def q_scd2_apply(i: Inputs) -> DataFrame:
    return scd.scd2_apply(i["tables"], i["catalog"], DAYS[2])


def scd_runs(i: Inputs, *runs: tuple[str, dt.date]) -> DataFrame:
    history = empty_target(i.spark, "tables")
    for seen, run_date in runs:
        history = durable(scd.scd2_apply(history, i[seen], run_date))
    return history


@query
def q_scd2_change(i: Inputs) -> DataFrame:
    return scd_runs(i, ("catalog", DAYS[0]), ("catalog_next", DAYS[1]))


@query
def q_scd2_same_day_rerun(i: Inputs) -> DataFrame:
    return scd_runs(i, ("catalog", DAYS[0]), ("catalog_next", DAYS[1]), ("catalog", DAYS[1]))


@query
def q_scd2_vanish(i: Inputs) -> DataFrame:
    return scd_runs(i, ("catalog", DAYS[0]), ("catalog_next", DAYS[1]), ("catalog_next", DAYS[2]))


@query
def q_scd2_return(i: Inputs) -> DataFrame:
    return scd_runs(i, ("catalog", DAYS[0]), ("catalog_next", DAYS[1]), ("catalog", DAYS[2]))


@query
def q_history_lookup(i: Inputs) -> DataFrame:
    return scd.history_lookup(i["tables"], "STANDARD.Brand#1")


# --- dependencies ---------------------------------------------------------------------------------


def internal_edges(i: Inputs) -> DataFrame:
    return deps.internal_view_edges(deps.view_dependency(i["pg_class"], i["pg_depend"], i["pg_namespace"]))


@query
def q_view_dependency(i: Inputs) -> DataFrame:
    return deps.view_dependency(i["pg_class"], i["pg_depend"], i["pg_namespace"])


@query
def q_view_text_match(i: Inputs) -> DataFrame:
    return deps.view_text_match(i["view_definitions"], i["tables"])


@query
def q_view_oid_backfill(i: Inputs) -> DataFrame:
    return deps.external_view_edges(i["view_definitions"], i["tables"], internal_edges(i))


@query
def q_object_dependencies(i: Inputs) -> DataFrame:
    inside = durable(internal_edges(i))  # read by both kinds of edges
    return deps.object_dependencies(inside, deps.external_view_edges(i["view_definitions"], i["tables"], inside))


@query
def q_dependency_lookup(i: Inputs) -> DataFrame:
    return deps.dependency_lookup(i["object_deps"], "rpt.v_1")


@query
def q_contains_join(i: Inputs) -> DataFrame:
    return matching.contains_join(i["hosts"], i["pages"], "host", "html", ["page_id"])


@query
def q_contains_join_plain(i: Inputs) -> DataFrame:
    current = i["tables"].where("most_recent")
    names = current.select(F.explode(F.array("table_name", "schema_name")).alias("name"))
    return grams.contains_join_plain(names, i["sql_queries"], "name", "querytxt", ["query_id"])


@query
def q_query_text_match(i: Inputs) -> DataFrame:
    return deps.query_text_match(i["sql_queries"], i["tables"], i["object_deps"])


@query
def q_longest_match(i: Inputs) -> DataFrame:
    return matching.longest_match(q_query_text_match(i), ["query_id"], "schema_table_length")


@query
def q_query_dependencies(i: Inputs) -> DataFrame:
    return deps.attribute_queries(i["sql_queries"], i["tables"], i["object_deps"])


# --- sizes ----------------------------------------------------------------------------------------


@query
def q_snapshot_replace_day(i: Inputs) -> DataFrame:
    return space.snapshot_replace_day(i["internal_space"], renamed(i["table_space_source"]), RUN_TS)


@query
def q_snapshot_audit(i: Inputs) -> DataFrame:
    return checks.snapshot_audit(q_snapshot_replace_day(i))


@query
def q_space_stage(i: Inputs) -> DataFrame:
    return space.space_stage(i["external_sizes"])


@query
def q_insert_if_absent(i: Inputs) -> DataFrame:
    stored = i["external_space"].where(F.col("snapshot_date") < day(STORED_UNTIL))
    return space.insert_if_absent(stored, q_space_stage(i), ["schema_table", "snapshot_date"])


@query
def q_table_space(i: Inputs) -> DataFrame:
    return space.table_space(i["internal_space"], i["external_space"])


@query
def q_key_violations(i: Inputs) -> DataFrame:
    return checks.key_violations(i["external_space"], ["schema_table", "snapshot_date"])


# --- daily statistics -----------------------------------------------------------------------------


@query
def q_object_lifespan(i: Inputs) -> DataFrame:
    return stats.object_lifespan(i["tables"], RUN_TS)


@query
def q_calendar_spine(i: Inputs) -> DataFrame:
    return stats.calendar_spine(q_object_lifespan(i), i["calendar"], RUN_TS)


@query
def q_size_islands(i: Inputs) -> DataFrame:
    return stats.size_islands(i["internal_space"], "schema_table", INTERNAL_VALUES)


@query
def q_interval_close(i: Inputs) -> DataFrame:
    return stats.size_intervals(i["external_space"], ["tablesize_kb"])


@query
def q_forward_fill_sizes(i: Inputs) -> DataFrame:
    inside = stats.size_intervals(i["internal_space"], INTERNAL_VALUES)
    outside = stats.size_intervals(i["external_space"], ["tablesize_kb"])
    return stats.forward_fill_sizes(q_calendar_spine(i), inside, outside)


@query
def q_asof_scd_join(i: Inputs) -> DataFrame:
    return stats.asof_scd_join(q_calendar_spine(i), i["tables"])


@query
def q_daily_usage_join(i: Inputs) -> DataFrame:
    return stats.daily_usage_join(q_calendar_spine(i), i["query_deps"])


@query
def q_size_excludes_latest(i: Inputs) -> DataFrame:
    return stats.size_excludes_latest(i["size_excludes"], i["external_space"])


@query
def q_table_stats_byday(i: Inputs) -> DataFrame:
    return stats.table_stats_byday(
        i["tables"], i["query_deps"], i["internal_space"], i["external_space"], i["size_excludes"], i["calendar"], RUN_TS
    )


@query
def q_data_lake_stats_byday(i: Inputs) -> DataFrame:
    return stats.data_lake_stats_byday(q_table_stats_byday(i))


# --- everything, two days in a row -----------------------------------------------------------------


def as_of(i: Inputs, run_ts: dt.datetime, changed: bool) -> dict[str, DataFrame]:
    """What the sources show at ``run_ts``: entries and sizes so far and, on the second day, some changed tables."""
    recoded = F.when(F.col("sortkey1").rlike("^[bs]") & F.lit(changed), F.lit("R")).otherwise(F.col("encoded"))
    return {
        "query_log": i["query_log"].where(F.col("starttime") < moment(run_ts)),
        "users": i["users"],
        "internal_tables": renamed(i["internal_raw"]).withColumn("encoded", recoded),
        "class_info": i["class_info"],
        "external_tables": i["external_tables"],
        "pg_class": i["pg_class"],
        "pg_depend": i["pg_depend"],
        "pg_namespace": i["pg_namespace"],
        "view_definitions": i["view_definitions"],
        "table_space_source": renamed(i["table_space_source"]).withColumn(
            "size", F.col("size") + F.lit(5 if changed else 0)
        ),
        "external_sizes": i["external_sizes"].where(F.col("created_at") < moment(run_ts)),
        "size_excludes": i["size_excludes"],
        "calendar": i["calendar"],
    }


@query
def q_run_all(i: Inputs) -> DataFrame:
    first = run_all(as_of(i, FIRST_RUN, False), new_state(i.spark), FIRST_RUN)
    second = run_all(as_of(i, RUN_TS, True), {name: first[name] for name in new_state(i.spark)}, RUN_TS)
    return second["table_stats_byday"]


# --- what two stored runs leave behind -----------------------------------------------------------------


def stored(i: Inputs, name: str) -> DataFrame:
    """A target table as read back after both days were stored; the runs take place once per session and folder."""
    if "stored" not in i.__dict__:
        root = f"{checkpoint_root(i.spark)}/tidemark-stored/{uuid.uuid4().hex}"
        for n, (run_ts, changed) in enumerate(((FIRST_RUN, False), (RUN_TS, True))):
            state = read_state(i.spark, root, stored=n > 0)
            with intermediates(i.spark):
                store_run(run_all(as_of(i, run_ts, changed), state, run_ts), root, run_ts, state)
        i.stored = root
    columns = [field.split(" ")[0] for field in TARGETS[name].split(", ")]
    return read_target(i.spark, i.stored, name).select(*columns)


@query
def q_stored_sql_queries(i: Inputs) -> DataFrame:
    return stored(i, "sql_queries")


@query
def q_stored_tables(i: Inputs) -> DataFrame:
    return stored(i, "tables")


@query
def q_stored_object_dependencies(i: Inputs) -> DataFrame:
    return stored(i, "object_dependencies")


@query
def q_stored_query_dependencies(i: Inputs) -> DataFrame:
    return stored(i, "query_dependencies")


@query
def q_stored_internal_table_space(i: Inputs) -> DataFrame:
    return stored(i, "internal_table_space")


@query
def q_stored_spectrum_table_space(i: Inputs) -> DataFrame:
    return stored(i, "spectrum_table_space")


def flagship(i: Inputs) -> DataFrame:
    """Who uses which table on which day: queries, users and durations, found in the query texts."""
    return stats.daily_usage(q_query_dependencies(i)).orderBy("date", "schema_table")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: function(Inputs.over(spark, sf_dir))

    return {name: bind(function) for name, function in QUERIES.items()}
