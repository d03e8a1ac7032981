import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.functions import average_whole, local_day, seconds_between
from tidemark.operators.checks import key_violations, load_audit, preview
from tidemark.operators.ingest import high_water_mark, ingest_incremental, query_search
from tidemark.operators import numbering
from tidemark.operators.numbering import global_row_number
from tidemark.session import durable
from tidemark.sources import INPUTS, TARGETS, empty_target

ORDER = ["starttime", "endtime", "userid", "querytxt", "aborted"]
RUN = ts("2024-02-01 06:00:00")


@pytest.fixture
def log(frame):
    return lambda *entries: frame(INPUTS["query_log"], *entries)


@pytest.fixture
def users(frame):
    return frame(INPUTS["users"], (1, "ann"), (2, "bob"))


def entry(user, text, start, end=None, aborted=0):
    return (user, text, ts(start), ts(end or start), aborted)


def test_seconds_count_boundaries_in_any_time_zone(spark, frame):
    df = frame(
        "a timestamp_ntz, b timestamp_ntz",
        (ts("2024-01-01 00:00:00.900"), ts("2024-01-01 00:00:01.100")),
        (ts("2024-03-10 01:59:59.900"), ts("2024-03-10 03:00:01.100")),  # New York skips this hour
        (ts("1969-12-31 23:59:58.500"), ts("1970-01-01 00:00:00.100")),
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [r[0] for r in df.select(seconds_between("a", "b")).collect()] == [1, 3602, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_local_day_of_utc_time(frame):
    df = frame("at timestamp_ntz", (ts("2024-01-01 03:00:00"),))
    assert str(df.select(local_day("at", "America/New_York")).first()[0]) == "2023-12-31"


def test_average_is_cut_to_whole_numbers(frame):
    df = frame("g int, v bigint", (1, 1), (1, 2), (2, -1), (2, -2), (3, None))
    out = df.groupBy("g").agg(average_whole(F.sum("v"), F.count("v")).alias("a"))
    assert rows(out, "g", "a") == [(1, 1), (2, -1), (3, None)]


def test_high_water_mark_of_empty_and_filled_target(spark, frame):
    assert tuple(high_water_mark(empty_target(spark, "sql_queries"), "starttime", "query_id").first()) == (
        ts("1900-01-01 00:00:00"),
        0,
    )
    stored = frame(TARGETS["sql_queries"], {"query_id": 7, "starttime": ts("2024-01-01 10:00:00")})
    assert tuple(high_water_mark(stored, "starttime", "query_id").first()) == (ts("2024-01-01 10:00:00"), 7)


def test_entries_at_the_mark_are_not_loaded(frame, log, users):
    stored = frame(TARGETS["sql_queries"], {"query_id": 7, "starttime": ts("2024-01-01 10:00:00")})
    new = log(entry(1, "a", "2024-01-01 10:00:00"), entry(9, "b", "2024-01-01 10:00:01", "2024-01-01 10:00:04", 1))
    out = ingest_incremental(new, users, stored, RUN)
    assert [f.simpleString() for f in out.schema] == [f.simpleString() for f in stored.schema]
    assert rows(out) == [
        (8, 9, "b", "unknown", 3, ts("2024-01-01 10:00:01"), ts("2024-01-01 10:00:04"), 1, RUN)
    ]


def test_second_run_over_the_same_log_adds_nothing(spark, log, users):
    entries = log(*(entry(1, f"q{n}", f"2024-01-01 10:00:{n:02d}") for n in range(20)))
    first = ingest_incremental(entries, users, empty_target(spark, "sql_queries"), RUN)
    assert [r[0] for r in rows(first, "query_id")] == list(range(1, 21))
    assert ingest_incremental(entries, users, first, RUN).count() == 0


def test_archive_and_current_log_merge_without_duplicates(spark, log, users):
    both, old = entry(1, "both", "2024-01-01 10:00:00"), entry(2, "old", "2023-12-31 10:00:00")
    out = ingest_incremental(log(both), users, empty_target(spark, "sql_queries"), RUN, log(both, old))
    assert rows(out, "query_id", "querytxt") == [(1, "old"), (2, "both")]


def test_ties_on_start_end_and_user_keep_their_ids(log):
    a, b = entry(1, "a", "2024-01-01 10:00:00"), entry(1, "b", "2024-01-01 10:00:00")
    for entries in ((a, b), (b, a)):
        assert rows(global_row_number(log(*entries), ORDER), "query_id", "querytxt") == [(1, "a"), (2, "b")]


def test_numbers_equal_the_global_window_with_hot_copies(log):
    rng = random.Random(1)
    entries = [entry(1, "hot", "2024-01-01 10:00:00")] * 700
    entries += [entry(rng.randrange(9), f"q{rng.randrange(50)}", f"2024-01-01 10:00:{rng.randrange(60):02d}") for _ in range(1300)]
    rng.shuffle(entries)
    df = log(*entries).repartition(6)
    ours = global_row_number(df, ORDER, start=100)
    plain = df.withColumn("query_id", F.row_number().over(Window.orderBy(*ORDER)) + F.lit(100))
    assert rows(ours, "query_id", *ORDER) == rows(plain, "query_id", *ORDER)


def test_copies_spread_over_partitions(log, monkeypatch):
    written = []
    monkeypatch.setattr(numbering, "durable", lambda df: written.append(durable(df)) or written[-1])
    copies = [entry(1, "hot", "2024-01-01 10:00:00")] * 2000
    others = [entry(2, f"q{n}", f"2024-01-01 10:{n // 60:02d}:{n % 60:02d}") for n in range(1000)]
    assert global_row_number(log(*copies, *others).repartition(8), ORDER).count() == 3000
    assert len(written) == 1  # the rows are written out once, in order
    sizes = [r[1] for r in written[0].groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1500


def test_partitions_grow_with_the_input(log, monkeypatch):
    few, many = (log(*[entry(1, "x" * 1000, "2024-01-01 10:00:00")] * n) for n in (5, 100))
    assert numbering.range_partitions(few, 10_000) == 4
    assert numbering.range_partitions(many, 10_000) > 10
    monkeypatch.setattr(numbering, "PARTITION_BYTES", 10)
    assert rows(global_row_number(few, ORDER), "query_id") == [(n,) for n in range(1, 6)]


def test_the_log_is_evaluated_once(spark, log):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda text: seen.add(1) or text, "string")
    df = log(*[entry(n, f"q{n}", "2024-01-01 10:00:00") for n in range(20)])
    assert global_row_number(df.withColumn("querytxt", count("querytxt")), ORDER).count() == 20
    assert seen.value == 20


def test_numbering_an_empty_log(log):
    assert global_row_number(log(), ORDER).count() == 0


def test_query_search_and_audit(frame):
    at = [ts(f"2024-01-01 10:00:0{n}") for n in range(4)]
    queries = frame(
        TARGETS["sql_queries"],
        {"query_id": 1, "querytxt": "from x.t", "duration_second": 61, "starttime": at[2], "created_at": RUN},
        {"query_id": 2, "querytxt": "from x.t", "duration_second": 60, "starttime": at[1], "created_at": RUN},
        {"query_id": 3, "querytxt": "in x.t y", "duration_second": 99, "starttime": at[0], "created_at": RUN},
        {"query_id": 4, "querytxt": "from x.T", "duration_second": 99, "starttime": at[3], "created_at": at[0]},
    )
    assert [r.duration_second for r in query_search(queries, "x.t", 60).collect()] == [99, 61]
    assert rows(load_audit(queries)) == [(at[0], at[3], at[3], 4, 4, 1), (RUN, at[0], at[2], 1, 3, 3)]
    assert [r.query_id for r in preview(queries, 2, ["starttime"]).collect()] == [3, 2]
    assert preview(queries, 3).count() == 3
    assert rows(key_violations(queries, ["created_at"])) == [(RUN, 3)]
