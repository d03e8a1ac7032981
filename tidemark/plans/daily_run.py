"""All loads of one day in the order their results depend on each other."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame, SparkSession

from tidemark import sinks
from tidemark.functions import moment
from tidemark.operators import dependencies as deps
from tidemark.operators import space, stats
from tidemark.operators.catalog import catalog_union, table_creation_times
from tidemark.operators.increments import matches_after
from tidemark.operators.ingest import ingest_incremental
from tidemark.operators.scd import scd2_apply
from tidemark.session import durable
from tidemark.sources import empty_target, read_target
from tidemark.sources.manifests import NOTHING, Published, newest

# The tables that a run reads back.
STATE = ["sql_queries", "tables", "query_matches", "matched_names", "internal_table_space", "spectrum_table_space"]
# The tables that a run adds rows to, and those that it replaces as a whole.
APPENDED = ["sql_queries", "query_matches"]
RELOADED = ["tables", "matched_names", "object_dependencies", "query_dependencies", "table_stats_byday"]


class State(dict[str, DataFrame]):
    """The tables that a run reads back, all as one published run left them."""

    run: Published = NOTHING


def new_state(spark: SparkSession) -> State:
    """The state before the first run."""
    return State({name: empty_target(spark, name) for name in STATE})


def run_all(
    inputs: dict[str, DataFrame],
    state: dict[str, DataFrame],
    run_ts: dt.datetime,
    min_date: dt.date = stats.COLLECTION_START,
    keep: Callable[[DataFrame], DataFrame] = durable,
) -> dict[str, DataFrame]:
    """Every result table and view after a run at ``run_ts``.

    ``inputs`` holds the DataFrames declared in :data:`tidemark.sources.INPUTS` and, optionally,
    ``query_log_history``. Rows to append come back under ``new_*`` names. ``keep`` holds on to
    results that several later steps read; by default it writes them to the checkpoint folder. The
    query texts are not copied there once more for each table that a query uses: ``query_dependencies``
    is joined from what was kept whenever it is read, by the statistics without the texts.
    """
    run_date = run_ts.date()

    def log() -> DataFrame:
        users = keep(inputs["users"].select("usesysid", "usename"))  # read whenever the log is, so that all of the run knows the same names
        return ingest_incremental(inputs["query_log"], users, state["sql_queries"], run_ts, inputs.get("query_log_history"))

    def catalog() -> tuple[DataFrame, DataFrame]:
        times = table_creation_times(inputs["class_info"], inputs["pg_namespace"])
        seen = keep(catalog_union(inputs["internal_tables"], times, inputs["external_tables"]))
        history = keep(scd2_apply(state["tables"], seen, run_date, run_ts))
        internal_edges = keep(
            deps.internal_view_edges(deps.view_dependency(inputs["pg_class"], inputs["pg_depend"], inputs["pg_namespace"]))
        )
        external_edges = deps.external_view_edges(inputs["view_definitions"], history, internal_edges)
        return history, keep(deps.object_dependencies(internal_edges, external_edges))

    def sizes() -> tuple[DataFrame, DataFrame]:
        every = space.snapshot_replace_day(state["internal_table_space"], inputs["table_space_source"], run_ts)
        staged = space.space_stage(inputs["external_sizes"])
        absent = space.insert_if_absent(state["spectrum_table_space"], staged, ["schema_table", "snapshot_date"])
        return every, keep(absent.withColumn("created_at", moment(run_ts)))

    # The three do not need each other, and each waits for small jobs of its own.
    with ThreadPoolExecutor(3) as pool:
        branches = [pool.submit(copy_context().run, branch) for branch in (log, catalog, sizes)]
        new_queries, (tables, objects), (internal_space, new_external) = [branch.result() for branch in branches]
    queries = state["sql_queries"].unionByName(new_queries)
    found = matches_after(
        deps.named_targets(tables, objects), state["sql_queries"], new_queries, state["query_matches"], state["matched_names"], run_ts
    )
    used = deps.attribute_matches(found.current, queries, tables, objects)
    new_internal = space.internal_snapshot(inputs["table_space_source"], run_ts)
    external_space = state["spectrum_table_space"].unionByName(new_external)

    by_day = keep(
        stats.table_stats_byday(
            tables, used, internal_space, external_space, inputs["size_excludes"], inputs["calendar"], run_ts, min_date
        )
    )
    return {
        "new_sql_queries": new_queries,
        "sql_queries": queries,
        "tables": tables,
        "object_dependencies": objects,
        "query_dependencies": used,
        "new_query_matches": found.added,
        "query_matches": state["query_matches"].unionByName(found.added),
        "matched_names": found.names,
        "new_internal_table_space": new_internal,
        "internal_table_space": internal_space,
        "new_spectrum_table_space": new_external,
        "spectrum_table_space": external_space,
        "table_stats_byday": by_day,
        "data_lake_stats_byday": stats.data_lake_stats_byday(by_day),
        "table_space": space.table_space(internal_space, external_space),
    }


def read_state(spark: SparkSession, root: str, stored: bool = True) -> State:
    """The state that the newest run published under ``root``; ``stored=False`` before the first run."""
    if not stored:
        return new_state(spark)
    run = newest(spark, root)
    state = State({name: read_target(spark, root, name, run) for name in STATE})
    state.run = run
    return state


def store_run(results: dict[str, DataFrame], root: str, run_ts: dt.datetime, state: State) -> Published:
    """Write one run's results and publish them as one: the log and the snapshots grow, the other tables are replaced.

    Readers see all of the run or, if any write fails, still the run before; it can then be repeated as it is.
    """
    loads = sinks.Loads(results["tables"].sparkSession, root, state.run, run_ts)
    today = run_ts.date()
    for name in RELOADED:
        loads.replace(name, results[name])
    for name in APPENDED:
        loads.append(name, results[f"new_{name}"])
    replace = space.holds_today_last(state["internal_table_space"], today)
    loads.append_day("internal_table_space", results["new_internal_table_space"], "snapshot_date", today, replace)
    loads.append("spectrum_table_space", results["new_spectrum_table_space"], "snapshot_date")
    return loads.publish()
