import datetime as dt
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tests.conftest import rows
from tidemark.plans import new_state, read_state, run_all, store_run
from tidemark.session import checkpoint_root, durable, intermediates
from tidemark import sinks
from tidemark.operators import dependencies as deps
from tidemark.sources import TARGETS, empty_target, read_inputs, read_target
from tidemark.sources.manifests import RUNS, names_in, newest, published
from workload import oracle, registry
from workload.inputs import Inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_a_sql_counterpart():
    assert set(registry.registered()) == set(oracle.oracle_sql())
    assert len(registry.registered()) == 49


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    count, difference_ = difference(registry.registered()[name](spark, SF), duck, oracle.oracle_sql()[name])
    assert not difference_
    assert count > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.registered()) <= set(entry.queries())


@pytest.fixture
def named_folder(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    yield tmp_path
    if before:
        spark.sparkContext._jsc.setCheckpointDir(before.rsplit("/", 1)[0])


def test_intermediate_results_go_to_the_folder_the_session_names(spark, named_folder):
    kept = durable(spark.range(5).toDF("n"))
    assert all(str(named_folder) in f for f in kept.inputFiles())
    assert rows(kept) == [(n,) for n in range(5)]


def test_nothing_is_left_of_what_a_block_owns(spark, named_folder):
    with intermediates(spark):
        assert rows(durable(spark.range(3).toDF("n"))) == [(0,), (1,), (2,)]
        assert list(named_folder.rglob("*.parquet"))
    assert not list(named_folder.rglob("*.parquet"))


def test_blocks_at_the_same_time_own_their_results_each(spark, named_folder):
    import contextvars
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(1) as pool, intermediates(spark) as outer:

        def other():
            with intermediates(spark) as inner:
                durable(spark.range(2).toDF("n"))
            return inner

        mine = durable(spark.range(3).toDF("n"))
        assert pool.submit(contextvars.copy_context().run, other).result() != outer
        assert all(outer.rsplit("/", 1)[1] in f for f in mine.inputFiles()) and mine.count() == 3


def test_a_write_observes_the_size_of_what_it_writes(spark, named_folder, monkeypatch):
    from tidemark.operators.joins import fits_broadcast
    from tidemark.session import measured, no_larger

    kept = durable(spark.createDataFrame([("abc",), (None,)], "v string"), nulls=F.count_if(F.col("v").isNull()))
    assert measured(kept) == {"bytes": 2 * 32 + 3, "rows": 2, "nulls": 1}
    assert measured(kept.select("v")) is None and measured(no_larger(kept.select("v"), kept, kept))["bytes"] == 134
    assert measured(durable(kept.where("false"))) == {"bytes": 0, "rows": 0}
    monkeypatch.setattr(type(kept), "agg", None)  # no further action
    assert fits_broadcast(kept)


def test_a_cluster_needs_a_shared_folder(tmp_path):
    def session(folder):
        context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: folder)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))

    for folder in (None, f"{tempfile.gettempdir()}/x", f"file://{tempfile.gettempdir()}/x"):
        with pytest.raises(RuntimeError, match="every executor"):
            checkpoint_root(session(folder))
    assert checkpoint_root(session("hdfs://nn/shared/")) == "hdfs://nn/shared"


# Rows of a small run: its number, in the first column of each table that takes it.
WRITTEN = ("tables", "matched_names", "object_dependencies", "query_dependencies", "table_stats_byday", "new_sql_queries",
           "new_query_matches", "new_internal_table_space", "new_spectrum_table_space")


def small_run(spark, root, day, n):
    """Store a run whose tables hold one row each, marked by ``n``."""
    results = {}
    for name in WRITTEN:
        ddl = TARGETS[name.removeprefix("new_")]
        values = {"snapshot_date": dt.date(2024, 1, day), "table_id": n, "query_id": n, "schema_table": f"s.t{n}", "name": f"n{n}"}
        row = tuple(values.get(c.split(" ")[0]) for c in ddl.replace("decimal(", "").split(", "))
        results[name] = spark.createDataFrame([row[: len(empty_target(spark, name.removeprefix("new_")).columns)]], ddl)
    return sinks_of(results, root, day, read_state(spark, root))


def sinks_of(results, root, day, state):
    return store_run(results, root, dt.datetime(2024, 1, day, 6), state)


def small_tables(spark, root):
    marks = {"sql_queries": "query_id", "query_matches": "query_id", "matched_names": "name", "query_dependencies": "query_id"}
    return {name: rows(read_target(spark, root, name), marks.get(name, "table_id")) for name in TARGETS}


def test_a_run_that_fails_at_any_write_leaves_the_run_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert all(not lot for lot in small_tables(spark, root).values())
    small_run(spark, root, 1, 1)
    before = small_tables(spark, root)
    assert set(map(tuple, before.values())) == {((1,),), (("n1",),)}
    write, manifest = sinks.write_folder, sinks.write_manifest
    for broken in range(len(WRITTEN) + 1):
        count = iter(range(100))

        def fails(*args):
            if next(count) == broken:
                raise OSError("disk full")
            return write(*args)

        monkeypatch.setattr(sinks, "write_folder", fails)
        if broken == len(WRITTEN):  # the manifest itself is cut short

            def cut_short(spark, root, base, stamp, tables):
                (tmp_path / RUNS / "00000002.json").write_text('{"number": 2, "stamp": "2024')
                raise OSError("disk full")

            monkeypatch.setattr(sinks, "write_manifest", cut_short)
        with pytest.raises(OSError, match="disk full"):
            small_run(spark, root, 2, 2)
        assert small_tables(spark, root) == before and newest(spark, root).number == 1
    monkeypatch.setattr(sinks, "write_folder", write)
    monkeypatch.setattr(sinks, "write_manifest", manifest)
    assert small_run(spark, root, 2, 2).number == 3  # the number of the broken one is not used again
    after = small_tables(spark, root)
    assert after["sql_queries"] == after["query_matches"] == after["internal_table_space"] == [(1,), (2,)]
    assert after["tables"] == after["table_stats_byday"] == [(2,)] and after["matched_names"] == [("n2",)]


def test_a_second_run_of_a_day_replaces_its_snapshot_only(spark, tmp_path):
    root = str(tmp_path)
    for day, n in ((1, 1), (2, 2), (2, 3)):
        small_run(spark, root, day, n)
    found = small_tables(spark, root)
    assert found["internal_table_space"] == [(1,), (3,)] and found["spectrum_table_space"] == [(1,), (2,), (3,)]


def test_of_two_runs_on_the_same_state_one_is_published(spark, tmp_path):
    root = str(tmp_path)
    small_run(spark, root, 1, 1)
    state = read_state(spark, root)
    small_run(spark, root, 2, 2)
    results = {name: empty_target(spark, name.removeprefix("new_")) for name in WRITTEN}
    with pytest.raises(RuntimeError, match="another run"):
        sinks_of(results, root, 3, state)
    assert [run.number for run in published(spark, root, 9)] == [2, 1]


def test_what_no_retained_run_lists_is_removed(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for n in range(1, 5):
        small_run(spark, root, n, n)
    before = small_tables(spark, root)
    assert len(names_in(spark, f"{root}/tables")) == 4
    assert sinks.remove_unlisted(spark, root, retain=2)
    assert [len(names_in(spark, f"{root}/{t}")) for t in ("tables", "sql_queries", RUNS)] == [2, 4, 2]
    assert small_tables(spark, root) == before and sinks.remove_unlisted(spark, root, retain=2) == []
    assert rows(read_target(spark, root, "tables", published(spark, root, 2)[1]), "table_id") == [(3,)]


def test_stored_runs_continue_each_other_and_a_rerun_changes_nothing(spark, tmp_path, named_folder):
    i = Inputs.over(spark, SF)
    source, root = str(tmp_path / "inputs"), str(tmp_path / "results")
    for name, df in registry.as_of(i, registry.FIRST_RUN, False).items():
        df.write.parquet(f"{source}/{name}")
    inputs = read_inputs(spark, source)

    def run(run_ts, stored):
        state = read_state(spark, root, stored)
        with intermediates(spark):
            store_run(run_all(inputs, state, run_ts), root, run_ts, state)
        return {name: rows(read_target(spark, root, name), *columns(name)) for name in TARGETS}

    def columns(name):
        return [c.split(" ")[0] for c in TARGETS[name].split(", ") if not c.startswith("created_at")]

    first = run(registry.FIRST_RUN, False)
    again = run(registry.FIRST_RUN + dt.timedelta(hours=1), True)
    assert first == again
    assert all(first[name] for name in TARGETS)
    assert not list((named_folder / "tidemark").rglob("*.parquet"))
    later = run(registry.FIRST_RUN + dt.timedelta(days=1), True)
    assert later["sql_queries"] == first["sql_queries"] and later["tables"] == first["tables"]
    assert len(later["internal_table_space"]) == 2 * len(first["internal_table_space"])
    assert set(new_state(spark)) <= set(TARGETS)


def test_stored_inputs_outlive_the_run_that_reads_them_first(spark, frame, tmp_path):
    part = frame("p_partkey bigint, p_type string, p_brand string", (1, "LARGE", "Brand#7"), (1, "LARGE", "Brand#8"))
    part.write.parquet(str(tmp_path / "part.parquet"))
    inputs = Inputs(spark, str(tmp_path))
    with intermediates(spark):
        inputs["part_names"]
    assert rows(inputs["part_names"]) == [(1, "LARGE.Brand#7")]


def test_a_run_keeps_no_text_once_more_for_each_table_it_names(spark):
    seen = []

    def keep(df):
        seen.append(df)
        return durable(df)

    results = run_all(registry.as_of(Inputs.over(spark, SF), registry.FIRST_RUN, False), new_state(spark), registry.FIRST_RUN, keep=keep)
    assert not [df.columns for df in seen if "querytxt" in df.columns]
    by_day = next(df for df in seen if "cnt_query" in df.columns)
    moved = [line for line in by_day._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
    assert moved and not [line for line in moved if "querytxt" in line.split("ReadSchema")[1]]
    used, queries = results["query_dependencies"], results["sql_queries"]
    assert rows(used, "query_id", "querytxt", "usename") == rows(used.select("query_id", "schema_table").join(queries, "query_id"), "query_id", "querytxt", "usename")
    assert rows(used) == rows(deps.attribute_queries(queries, results["tables"], results["object_dependencies"]).select(*used.columns))


def test_creation_times_are_looked_up_in_the_line_items_once(spark):
    assert not [f for f in Inputs.over(spark, SF)["class_info"].inputFiles() if "lineitem" in f]
