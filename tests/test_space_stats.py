import datetime as dt
import decimal
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import d, rows, ts
from tidemark.operators import space, stats
from tidemark.operators.checks import snapshot_audit
from tidemark.sources import INPUTS, TARGETS

DAY = {n: d(f"2024-01-{n:02d}") for n in range(1, 32)}
NOON = lambda n: ts(f"2024-01-{n:02d} 12:00:00")
OPEN = d("2999-01-01")
SIZE_END = d("2099-01-01")
dec = decimal.Decimal


@pytest.fixture
def internal(frame):
    """Internal snapshots out of (day, table, kb, rows)."""
    return lambda *r: frame(
        TARGETS["internal_table_space"],
        *({"snapshot_date": DAY[n], "schema_table": t, "tablesize_kb": kb and dec(kb), "tbl_rows": c and dec(c)} for n, t, kb, c in r),
    )


@pytest.fixture
def external(frame):
    """External snapshots out of (day, table, kb)."""
    return lambda *r: frame(
        TARGETS["spectrum_table_space"],
        *({"snapshot_date": DAY.get(n, n), "schema_table": t, "tablesize_kb": kb, "table_id": -1} for n, t, kb in r),
    )


@pytest.fixture
def tables(frame):
    """Table versions out of (name, first day, last day or None for open)."""
    return lambda *r: frame(
        TARGETS["tables"],
        *(
            {"schema_table": t, "schema_name": t.split(".")[0], "start_date": DAY[a], "end_date": DAY[b] if b else OPEN,
             "most_recent": b is None, "objectsrc": "spectrum_table" if t[0] == "x" else "internal_table", "encoded": f"v{a}"}
            for t, a, b in r
        ),
    )


@pytest.fixture
def used(frame):
    """Query edges out of (table, day, query id, user, seconds, aborted)."""
    return lambda *r: frame(
        TARGETS["query_dependencies"],
        *({"schema_table": t, "starttime": NOON(n), "query_id": q, "usename": u, "duration_second": s, "aborted": a}
          for t, n, q, u, s, a in r),
    )


@pytest.fixture
def calendar(frame):
    return frame(INPUTS["calendar"], *((day,) for day in DAY.values()))


@pytest.fixture
def excludes(frame):
    return lambda *r: frame(INPUTS["size_excludes"], *r)


# --- snapshots ------------------------------------------------------------------------------------


def test_todays_snapshot_is_replaced_unless_a_later_one_is_stored(frame, internal):
    source = frame(INPUTS["table_space_source"], {"table_id": 1, "schema": "s ", "table": "t", "size": 3})
    stored = internal((1, "s.t", "1", "1"), (2, "s.t", "1", "1"))
    out = space.snapshot_replace_day(stored, source, NOON(2))
    assert out.columns == stored.columns
    assert rows(out, "snapshot_date", "schema_table", "tablesize_kb") == [
        (DAY[1], "s.t", dec("1.0")), (DAY[2], "s .t", dec("3072.0")),
    ]
    later = internal((2, "s.t", "1", "1"), (3, "s.t", "1", "1"))
    assert rows(snapshot_audit(space.snapshot_replace_day(later, source, NOON(2))), "snapshot_date", "cnt") == [
        (DAY[2], 2), (DAY[3], 1),
    ]


def test_staged_sizes_use_the_local_day_but_are_cut_by_the_utc_day(frame):
    stage = frame(
        INPUTS["external_sizes"],
        ("x.e", 1, ts("2024-01-01 03:00:00")), ("x.e", 2, ts("2021-11-15 00:00:00")), ("x.e", 3, ts("2021-11-14 23:59:59")),
    )
    assert rows(space.space_stage(stage), "snapshot_date", "table_id", "tablesize_kb") == [
        (d("2021-11-14"), -1, 2), (d("2023-12-31"), -1, 1),
    ]


def test_rows_of_one_batch_do_not_exclude_each_other(external):
    batch = external((1, "x.e", 1), (1, "x.e", 2), (2, "x.e", 3)).drop("created_at")
    keys = ["schema_table", "snapshot_date"]
    stored = external((2, "x.e", 9))
    first = space.insert_if_absent(stored, batch, keys)
    assert rows(first, "tablesize_kb") == [(1,), (2,)]
    assert space.insert_if_absent(stored.drop("created_at").unionByName(first), batch, keys).count() == 0


def test_only_the_days_of_the_batch_are_read_from_the_target(spark, external, tmp_path):
    stored = external(*((n, "x.e", 9) for n in range(1, 10)))
    stored.write.partitionBy("snapshot_date").parquet(str(tmp_path / "t"))
    target = spark.read.schema(stored.schema).parquet(str(tmp_path / "t"))
    new = space.insert_if_absent(target, external((4, "x.e", 1), (5, "x.f", 1)), ["schema_table", "snapshot_date"])
    assert rows(new, "schema_table") == [("x.f",)]
    plan = new._jdf.queryExecution().executedPlan().toString()
    read = next(line for line in plan.splitlines() if "PartitionFilters" in line and str(tmp_path) in line)
    assert "snapshot_date" in read.split("PartitionFilters: [")[1].split("]")[0]
    nothing = space.insert_if_absent(target, external(), ["schema_table", "snapshot_date"])
    assert nothing.count() == 0


def test_newest_flag_goes_by_id_inside_and_by_name_outside(frame, external):
    ddl = TARGETS["internal_table_space"]
    inside = frame(
        ddl,
        {"snapshot_date": DAY[1], "table_id": 1, "schema_table": "s.t", "tablesize_kb": dec("1572864"), "tbl_rows": dec(5)},
        {"snapshot_date": DAY[2], "table_id": 2, "schema_table": "s.t", "tablesize_kb": dec("5242.9")},
        {"snapshot_date": DAY[1], "table_id": 2, "schema_table": "s.t", "tablesize_kb": None},
    )
    out = space.table_space(inside, external((1, "x.e", 1), (2, "x.e", 131072)))
    assert rows(out, "objectsrc", "snapshot_date", "table_id", "tablesize_gb", "last_snd_flag") == [
        ("external", DAY[1], -1, dec("0.00"), 0), ("external", DAY[2], -1, dec("0.13"), 1),
        ("internal", DAY[1], 1, dec("1.50"), 1), ("internal", DAY[1], 2, None, 0), ("internal", DAY[2], 2, dec("0.01"), 1),
    ]


# --- spine and intervals ----------------------------------------------------------------------------


def test_lifespan_counts_open_ends_up_to_today(tables):
    out = stats.object_lifespan(tables(("s.t", 2, 4), ("s.t", 5, None), ("s.u", 3, 6)), NOON(10))
    assert rows(out) == [("s.t", "s", DAY[2], DAY[10]), ("s.u", "s", DAY[3], DAY[6])]
    missing = tables(("s.t", 2, None)).withColumn("end_date", F.lit(None).cast("date"))
    assert rows(stats.object_lifespan(missing, NOON(10))) == [("s.t", "s", DAY[2], None)]


def test_spine_bounds(frame, calendar):
    life = frame("schema_table string, schema_name string, fd date, ld date",
                 ("s.t", "s", DAY[3], DAY[9]), ("s.back", "s", DAY[5], DAY[4]), ("s.null", "s", None, DAY[4]))
    out = stats.calendar_spine(life, calendar, NOON(5), DAY[3])
    assert rows(out, "schema_table", "date") == [("s.t", DAY[4]), ("s.t", DAY[5])]
    at_midnight = stats.calendar_spine(life, calendar, ts("2024-01-05 00:00:00"), DAY[3])
    assert rows(at_midnight, "date") == [(DAY[4],)]


def test_default_start_of_collection(frame):
    days = frame(INPUTS["calendar"], (d("2021-11-11"),), (d("2021-11-12"),))
    life = frame("schema_table string, schema_name string, fd date, ld date", ("s.t", "s", d("2021-11-01"), d("2021-12-01")))
    assert rows(stats.calendar_spine(life, days, NOON(1)), "date") == [(d("2021-11-12"),)]


def test_runs_join_snapshots_over_missing_days(internal):
    out = stats.size_islands(
        internal((1, "s.t", "5", "1"), (2, "s.t", "5", "1"), (5, "s.t", "5", "1"), (6, "s.t", "5", "2"), (7, "s.t", "5", "1")),
        "schema_table", ["tablesize_kb", "tbl_rows"],
    )
    assert rows(out, "start_date", "tbl_rows") == [(DAY[1], 1), (DAY[6], 2), (DAY[7], 1)]


def test_random_runs_equal_the_rank_difference(spark, external):
    rng = random.Random(5)
    data = [(rng.randrange(1, 20), rng.choice(["x.a", "x.b", None]), rng.choice([1, 2, 3, None])) for _ in range(200)]
    snapshots = external(*data)
    snapshots.createOrReplaceTempView("snapshots")
    plain = spark.sql("""
        SELECT min(snapshot_date) AS start_date, schema_table, tablesize_kb FROM (
          SELECT *, dense_rank() OVER (PARTITION BY schema_table ORDER BY snapshot_date)
            - dense_rank() OVER (PARTITION BY schema_table, tablesize_kb ORDER BY snapshot_date) AS run FROM snapshots)
        GROUP BY schema_table, tablesize_kb, run""")
    assert rows(stats.size_islands(snapshots, "schema_table", ["tablesize_kb"])) == rows(plain)


def test_sizes_fill_forward_only(frame, internal, external):
    spine = frame("schema_table string, date date", *(("s.t", DAY[n]) for n in range(1, 6)))
    inside = stats.size_intervals(internal((3, "s.t", "7.5", "1"), (5, "s.t", "8", "1")), ["tablesize_kb", "tbl_rows"])
    outside = stats.size_intervals(external((2, "s.t", 4)), ["tablesize_kb"])
    out = stats.forward_fill_sizes(spine, inside, outside)
    assert rows(out, "date", "tablesize_kb", "tbl_rows") == [
        (DAY[1], None, None), (DAY[2], 4.0, None), (DAY[3], 7.5, 1), (DAY[4], 7.5, 1), (DAY[5], 8.0, 1),
    ]


def test_version_of_the_day(frame, tables):
    spine = frame("schema_table string, date date", *(("s.t", DAY[n]) for n in range(1, 6)))
    out = stats.asof_scd_join(spine, tables(("s.t", 2, 3), ("s.t", 4, None)))
    assert rows(out, "date", "encoded", "table_id") == [
        (DAY[2], "v2", -1), (DAY[3], "v2", -1), (DAY[4], "v4", -1), (DAY[5], "v4", -1),
    ]


def exchanges(df):
    """Shuffles by a key in the plan, reused ones not counted again."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_runs_and_their_ends_take_three_shuffles(internal, external):
    values = ["tablesize_kb", "tbl_rows"]
    inside, outside = internal((1, "s.t", "1", "1")), external((1, "x.e", 1))
    assert exchanges(stats.size_islands(inside, "schema_table", values)) <= 3
    assert exchanges(stats.size_intervals(inside, values)) <= 3
    assert exchanges(stats.size_intervals(outside, ["tablesize_kb"])) <= 3


def test_random_ends_equal_the_next_later_start(spark, external):
    rng = random.Random(8)
    data = [(rng.randrange(1, 25), rng.choice(["x.a", "x.b", None]), rng.choice([1, 2, 3, None])) for _ in range(200)]
    snapshots = external(*data)
    islands = stats.size_islands(snapshots, "schema_table", ["tablesize_kb"]).collect()
    starts = {}
    for r in islands:
        starts.setdefault(r.schema_table, set()).add(r.start_date)
    plain = [
        (r.schema_table, r.tablesize_kb, r.start_date,
         min((s for s in starts[r.schema_table] if s > r.start_date), default=SIZE_END + dt.timedelta(days=1)) - dt.timedelta(days=1))
        for r in islands
    ]
    key = lambda r: tuple((v is not None, v) for v in r)
    got = rows(stats.size_intervals(snapshots, ["tablesize_kb"]), "schema_table", "tablesize_kb", "start_date", "end_date")
    assert got == sorted(plain, key=key)


def test_a_sweep_equals_the_join_on_between(spark, frame):
    rng = random.Random(12)
    cuts = {t: sorted(rng.sample(range(1, 28), 6)) for t in "abc"}
    intervals = []
    for t, starts in cuts.items():
        for first, following in zip(starts, [*starts[1:], 31], strict=True):
            last = rng.randrange(first, following)  # some gaps
            intervals += [(t, DAY[first], DAY[last], rng.randrange(9)) for _ in range(rng.randrange(1, 4))]
    intervals += [(None, DAY[1], DAY[30], 5), ("a", None, DAY[30], 5), ("d", DAY[3], DAY[2], 5)]
    changes = frame("schema_table string, start_date date, end_date date, v int", *intervals)
    spine = frame("schema_table string, date date, w int", *((t, day, n % 2) for t in ("a", "b", "d", "e", None) for n, day in DAY.items() for _ in range(1 + n % 2)))
    spine.createOrReplaceTempView("spine")
    changes.createOrReplaceTempView("changes")
    found = stats.carry_forward(spine, {"one": changes, "two": changes.where("v < 5")})
    for name, limit in (("one", 9), ("two", 5)):
        plain = spark.sql(f"""SELECT s.*, v FROM spine s LEFT JOIN changes c ON s.schema_table = c.schema_table
                              AND s.date BETWEEN c.start_date AND c.end_date AND v < {limit}""")
        got = found.select("schema_table", "date", "w", F.explode_outer(name).alias("x")).select("schema_table", "date", "w", "x.v")
        assert rows(got) == rows(plain)
    assert exchanges(found) == 1


def test_overlapping_intervals_are_refused(frame):
    spine = frame("schema_table string, date date", ("a", DAY[1]), ("a", DAY[9]))
    changes = frame("schema_table string, start_date date, end_date date, v int", ("a", DAY[1], DAY[5], 1), ("a", DAY[5], DAY[9], 2))
    with pytest.raises(Exception, match="intervals of size overlap: a"):
        stats.carry_forward(spine, {"size": changes}).collect()


def test_changes_that_share_a_start_are_listed_once(frame):
    spine = frame("schema_table string, date date", ("a", DAY[1]), ("a", DAY[2]), ("a", DAY[4]), ("a", DAY[4]))
    intervals = [("a", DAY[2], DAY[3], v) for v in range(2000)] + [("a", DAY[4], DAY[5], 7)]
    changes = frame("schema_table string, start_date date, end_date date, v int", *intervals)
    found = stats.carry_forward(spine, {"size": changes})
    assert rows(found.select("date", F.size("size").alias("n"))) == [(DAY[1], None), (DAY[2], 2000), (DAY[4], 1), (DAY[4], 1)]
    # a list made by a window is held by each of the rows it was made of, so their number would grow with the square
    plan = found._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line]
    assert windows and not any("collect_list" in line for line in windows)


def test_shuffles_of_the_daily_tables(frame, tables, used, internal, external, excludes, calendar):
    spine = stats.calendar_spine(stats.object_lifespan(tables(("s.t", 1, None)), NOON(9)), calendar, NOON(9))
    sizes = [stats.size_intervals(internal((1, "s.t", "1", "1")), ["tablesize_kb", "tbl_rows"]), stats.size_intervals(external((1, "x.e", 1)), ["tablesize_kb"])]
    assert exchanges(stats.forward_fill_sizes(spine, *sizes)) <= 8
    assert exchanges(stats.asof_scd_join(spine, tables(("s.t", 1, None)))) <= 8
    whole = stats.table_stats_byday(
        tables(("s.t", 1, None)), used(("s.t", 1, 1, "u", 3, 1)), internal((1, "s.t", "1", "1")), external((1, "x.e", 1)), excludes(("x.f", "w", NOON(1))),
        calendar, NOON(9),
    )
    assert exchanges(whole) <= 13
    assert "Expand" not in whole._jdf.queryExecution().executedPlan().toString()


def test_reasons_are_dropped_once_a_size_is_known(excludes, external):
    reasons = excludes(
        ("x.a", "old", NOON(1)), ("x.a", "new", NOON(2)), ("x.a", "new", NOON(2)), ("x.b", "sized", NOON(1)), (None, "none", NOON(1))
    )
    assert rows(stats.size_excludes_latest(reasons, external((1, "x.b", 1)))) == [("x.a", "new"), ("x.a", "new")]
    assert rows(stats.size_excludes_latest(reasons, external((1, "x.b", 1), (1, None, 1)))) == []


# --- daily statistics -------------------------------------------------------------------------------


def test_idle_days_count_zero_and_averages_are_whole(frame, used):
    spine = frame("schema_table string, date date", ("s.t", DAY[1]), ("s.t", DAY[2]))
    out = stats.daily_usage_join(spine, used(("s.t", 1, 1, "a", 1, 1), ("s.t", 1, 2, "a", 2, 0)))
    assert rows(out) == [("s.t", DAY[1], 2, 1, 1, 1, 2, 1), ("s.t", DAY[2], 0, 0, 0, 0, 0, 0)]


def sizes_on(snapshots, table, day):
    """The values that began on the last day, up to ``day``, on which some value of the table began."""
    own = {}
    for s in snapshots:
        if s["schema_table"] == table:
            own.setdefault(s["snapshot_date"], set()).add((s["tablesize_kb"], s.asDict().get("tbl_rows")))
    begun, before = [], set()
    for at in sorted(own):
        if at <= day and own[at] - before:
            begun = own[at] - before
        before = own[at]
    return begun or [(None, None)]


def direct_stats(run_ts, tables, used, internal, external, excludes, calendar):
    """The daily table row by row in Python."""
    last = (run_ts - dt.timedelta(microseconds=1)).date()
    sized = {s["schema_table"] for s in external}
    groups = Counter()
    for t in tables:
        own = [x for x in excludes if x["schema_table"] == t["schema_table"] and x["schema_table"] not in sized]
        newest = max((x["created_at"] for x in own), default=None)
        reasons = [x["exclude_reason"] for x in own if x["created_at"] == newest] or [None]
        for day in (c["date"] for c in calendar if t["start_date"] <= c["date"] <= min(t["end_date"], last)):
            for (kb, n), (other, _), why in itertools.product(
                sizes_on(internal, t["schema_table"], day), sizes_on(external, t["schema_table"], day), reasons
            ):
                size = kb if kb is not None else other
                groups[day, t["schema_table"], t["encoded"], None if size is None else float(size), n, why] += 1
    for (day, name, encoded, kb, _, why), copies in groups.items():
        queries = [q for q in used if q["schema_table"] == name and q["starttime"].date() == day]
        seconds = [q["duration_second"] for q in queries] or [0]
        yield (day, name, encoded, kb, why, len({q["query_id"] for q in queries}), len({q["usename"] for q in queries}),
               copies * sum(q["aborted"] for q in queries), min(seconds), max(seconds), sum(seconds) // len(seconds))


def test_table_stats_equal_the_direct_form(tables, used, internal, external, excludes, calendar):
    rng = random.Random(11)
    names = ["s.a", "s.b", "x.c", "x.d"]
    views = {
        "tables": tables(("s.a", 1, 4), ("s.a", 5, None), ("s.b", 3, 8), ("x.c", 2, None), ("x.d", 1, None)),
        "used": used(*((rng.choice(names), rng.randrange(1, 12), q, rng.choice("uvw"), rng.randrange(9), q % 2) for q in range(150))),
        "internal": internal(*((rng.randrange(1, 12), rng.choice(names[:2]), rng.choice("12"), rng.choice("12")) for _ in range(30))),
        "external": external(*((rng.randrange(1, 12), "x.c", rng.randrange(3)) for _ in range(20))),
        "excludes": excludes(("x.d", "why", NOON(3)), ("x.d", "why", NOON(3)), ("x.d", "also", NOON(3)), ("x.c", "no", NOON(3))),
        "calendar": calendar.unionByName(calendar.where(F.col("date") == DAY[6])),
    }
    ours = stats.table_stats_byday(*views.values(), NOON(10))
    plain = direct_stats(NOON(10), **{name: df.collect() for name, df in views.items()})
    assert [f.simpleString() for f in ours.schema] == [
        f.strip().replace(" ", ":", 1) for f in TARGETS["table_stats_byday"].replace(", ", ";").split(";")
    ]
    columns = ["snapshot_date", "schema_table", "encoded", "tablesize_kb", "size_exclude_reason", "cnt_query", "cntd_usename",
               "sum_aborted", "min_query_duration_sec", "max_query_duration_sec", "avg_query_duration_sec"]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert rows(ours, *columns) == sorted(plain, key=key)
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_equal_reasons_repeat_aborted_queries_only(tables, used, internal, external, excludes, calendar):
    twice = excludes(("x.e", "why", NOON(1)), ("x.e", "why", NOON(1)))
    out = stats.table_stats_byday(
        tables(("x.e", 1, None)), used(("x.e", 1, 1, "u", 3, 1)), internal(), external(), twice, calendar, NOON(1)
    )
    assert rows(out, "cnt_query", "sum_aborted", "avg_query_duration_sec", "size_exclude_reason") == [(1, 2, 3, "why")]


def test_lake_totals(frame):
    ddl = TARGETS["table_stats_byday"]

    def row(day, source, **values):
        return {"snapshot_date": DAY[day], "objectsrc": source, "cnt_query": 0, "sum_aborted": 0, "avg_query_duration_sec": 0, **values}

    table_stats = frame(
        ddl,
        row(1, "internal_table", tablesize_kb=1048576.0, cnt_query=3, sum_aborted=1, avg_query_duration_sec=5),
        row(1, "internal_table", tablesize_kb=524288.0),
        row(1, "spectrum_table", size_exclude_reason="why"),
        row(2, "spectrum_table", tablesize_kb=3145728.0, cnt_query=1),
    )
    assert rows(stats.data_lake_stats_byday(table_stats)) == [
        (DAY[1], 2, 1, 1, 2.0, 0.0, 2, 0, dec("0.333333"), None),
        (DAY[2], 0, 1, 0, 0.0, 3.0, None, 0, None, dec("0.000000")),
    ]
