import pytest

from tests.conftest import d, rows, ts
from tidemark.operators.catalog import catalog_filter, catalog_union, table_creation_times
from tidemark.operators.scd import changed_rows, history_lookup, interval_close, scd2_apply
from tidemark.session import durable
from tidemark.sources import INPUTS, TABLE_ATTRIBUTES, TARGETS, empty_target

ATTRIBUTES_DDL = TARGETS["tables"].split("most_recent boolean, ")[1].rsplit(", created_at", 1)[0]
D1, D2, D3, D4, OPEN = d("2024-01-01"), d("2024-01-02"), d("2024-01-03"), d("2024-01-04"), d("2999-01-01")
LIFE = ["schema_table", "start_date", "end_date", "most_recent", "diststyle"]


@pytest.fixture
def seen(frame):
    """A catalog out of (name, id, diststyle)."""

    def build(*tables):
        return frame(ATTRIBUTES_DDL, *({"schema_table": n, "table_id": i, "diststyle": s} for n, i, s in tables))

    return build


@pytest.fixture
def run(spark, seen):
    """Apply (day, catalog) runs in turn, from an empty history."""

    def apply(*runs, **options):
        history = empty_target(spark, "tables")
        for day, tables in runs:
            history = durable(scd2_apply(history, seen(*tables), day, **options))
        return rows(history, *LIFE)

    return apply


A, B = ("s.a", 1, "even"), ("s.b", 2, "even")
A2 = ("s.a", 1, "key")


def test_system_temporary_and_missing_schemas_drop_out(frame):
    df = frame("s string", ("pg_catalog",), ("pg_temp_1",), ("pgxtemp_1",), (None,), ("sales",))
    assert rows(catalog_filter(df, "s")) == [("sales",)]


def test_union_trims_names_and_pads_columns(frame):
    inside = frame(
        INPUTS["internal_tables"],
        {"table_id": 1, "table": " t ", "schema": "s ", "encoded": "Y"},
        {"table_id": 2, "table": "x", "schema": "pg_temp_9"},
    )
    classes = frame(INPUTS["class_info"], (1, " t", 5, ts("2020-01-01")), (3, "u", 9, ts("2020-01-01")))
    spaces = frame(INPUTS["pg_namespace"], (5, "s "), (6, "pg_catalog"))
    times = table_creation_times(classes, spaces)
    assert rows(times) == [(1, "s.t", ts("2020-01-01"))]
    row = {"tablename": "e", "schemaname": " x", "location": "here", "compressed": 1}
    outside = frame(INPUTS["external_tables"], row, row)
    out = catalog_union(inside, times, outside)
    assert out.columns == TABLE_ATTRIBUTES
    assert rows(out, "table_id", "schema_table", "objectsrc", "location", "table_creation_time", "encoded", "compressed") == [
        (-1, "x.e", "spectrum_table", "here", None, None, 1),
        (1, "s.t", "internal_table", "cluster", ts("2020-01-01"), "Y", None),
    ]


def test_changed_rows_treats_null_as_equal(frame):
    ddl = "name string, v int, most_recent boolean"
    current = frame(ddl, ("a", None, True), ("b", 1, True), ("c", 1, False))
    incoming = frame(ddl, ("a", None, None), ("b", 2, None), ("c", 1, None), ("c", 1, None))
    assert rows(changed_rows(incoming, current, ["name", "v"])) == [("b", 2), ("c", 1)]


def test_new_tables_open_and_an_unchanged_day_changes_nothing(run):
    once = [("s.a", D1, OPEN, True, "even"), ("s.b", D1, OPEN, True, "even")]
    assert run((D1, [A, B])) == once
    assert run((D1, [A, B]), (D2, [A, B])) == once
    assert run((D1, [A, B]), (D1, [A, B])) == once


def test_a_change_closes_the_old_version_the_day_before(run):
    assert run((D1, [A]), (D3, [A2])) == [("s.a", D1, D2, False, "even"), ("s.a", D3, OPEN, True, "key")]


def test_same_day_rerun_replaces_todays_version(run):
    assert run((D1, [A]), (D2, [A2]), (D2, [("s.a", 1, "all")])) == [
        ("s.a", D1, D1, False, "even"), ("s.a", D2, OPEN, True, "all"),
    ]
    assert run((D1, [A]), (D1, [A2])) == [("s.a", D1, OPEN, True, "key")]


def test_change_and_back_on_one_day_leaves_equal_neighbours(run):
    assert run((D1, [A]), (D2, [A2]), (D2, [A])) == [("s.a", D1, D1, False, "even"), ("s.a", D2, OPEN, True, "even")]


def test_a_rename_is_a_new_table_and_the_old_name_stays_open(run):
    assert run((D1, [("a.old", 1, "x")]), (D2, [("a.new", 1, "x")])) == [
        ("a.new", D2, OPEN, True, "x"), ("a.old", D1, OPEN, True, "x"),
    ]


def test_external_tables_share_an_id_and_do_not_close_one_by_one(run):
    e, f = ("x.e", -1, None), ("x.f", -1, None)
    assert run((D1, [e, f]), (D2, [e])) == [("x.e", D1, OPEN, True, None), ("x.f", D1, OPEN, True, None)]
    assert run((D1, [e, f]), (D2, [e]), close_by="schema_table") == [
        ("x.e", D1, OPEN, True, None), ("x.f", D1, D2, True, None),
    ]


def test_the_end_of_a_vanished_table_moves_with_each_run(run):
    runs = [(D1, [A, B]), (D2, [B]), (D3, [B])]
    assert run(*runs[:2])[0] == ("s.a", D1, D2, True, "even")
    assert run(*runs)[0] == ("s.a", D1, D3, True, "even")
    assert run(*runs, sticky_close=True)[0] == ("s.a", D1, D2, True, "even")


def test_a_vanished_table_that_returns(run):
    assert run((D1, [A, B]), (D2, [B]), (D3, [A, B]))[0] == ("s.a", D1, OPEN, True, "even")
    assert run((D1, [A, B]), (D2, [B]), (D4, [A2, B]))[:2] == [
        ("s.a", D1, D3, False, "even"), ("s.a", D4, OPEN, True, "key"),
    ]


def test_an_empty_catalog_closes_all_and_a_missing_id_none(run):
    no_id = ("s.c", None, "x")
    assert run((D1, [A, no_id]), (D2, [])) == [("s.a", D1, D2, True, "even"), ("s.c", D1, D2, True, "x")]
    assert run((D1, [A]), (D2, [no_id]))[0] == ("s.a", D1, OPEN, True, "even")
    assert run((D1, [A, no_id]), (D2, [B]))[2] == ("s.c", D1, OPEN, True, "x")


def test_creation_stamps_stay_on_kept_versions(spark, seen):
    first = scd2_apply(empty_target(spark, "tables"), seen(A), D1, ts("2024-01-01 05:00:00"))
    second = scd2_apply(first, seen(A, B), D2, ts("2024-01-02 05:00:00"))
    assert second.columns == first.columns == empty_target(spark, "tables").columns
    assert rows(second, "schema_table", "created_at") == [("s.a", ts("2024-01-01 05:00:00")), ("s.b", ts("2024-01-02 05:00:00"))]


def test_bad_runs_are_refused(spark, seen):
    history = scd2_apply(empty_target(spark, "tables"), seen(A), D2)
    with pytest.raises(ValueError, match="before the stored start"):
        scd2_apply(history, seen(A), D1)
    with pytest.raises(ValueError, match="not unique"):
        scd2_apply(history, seen(A, A2), D3)
    with pytest.raises(ValueError, match="NULL"):
        scd2_apply(history, seen((None, 1, "x")), D3)


def test_interval_close_skips_to_the_next_later_start(frame):
    df = frame("k string, start_date date, v int", ("a", D1, 1), ("a", D1, 2), ("a", D3, 3), (None, D1, 4), (None, D2, 5))
    end = d("2099-01-01")
    assert rows(interval_close(df, "k", "start_date", end), "v", "end_date") == [(1, D2), (2, D2), (3, end), (4, D1), (5, end)]


def test_history_lookup_is_ordered(frame):
    tables = frame(
        TARGETS["tables"],
        {"schema_table": "s.a", "start_date": D3},
        {"schema_table": "s.a", "start_date": D1},
        {"schema_table": "s.ab", "start_date": D2},
    )
    assert [r.start_date for r in history_lookup(tables, "s.a").collect()] == [D1, D3]
