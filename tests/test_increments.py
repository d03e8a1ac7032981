"""Matches kept from run to run against matching everything anew."""

import datetime as dt
import random

import pytest

from tests.conftest import rows
from tidemark.operators import dependencies as deps
from tidemark.operators import increments, matching
from tidemark.operators.increments import additions, matches_after
from tidemark.operators.matching import contains_join
from tidemark.sources import TARGETS, empty_target

COLUMNS = ("query_id", "name", "match_location", "name_length")
RUN = {n: dt.datetime(2024, 1, n, 6) for n in range(1, 30)}


@pytest.fixture
def log(frame):
    return lambda *r: frame("query_id bigint, querytxt string", *r)


@pytest.fixture
def names(frame):
    return lambda *n: frame("name string", *((x,) for x in n))


class Store:
    """What the runs leave: the texts seen, the matches appended and the newest list of names."""

    def __init__(self, spark, log):
        self.texts, self.matches, self.known = log(), empty_target(spark, "query_matches"), empty_target(spark, "matched_names")
        self.day = 0

    def run(self, names, new):
        self.day += 1
        found = matches_after(names, self.texts, new, self.matches, self.known, RUN[self.day])
        self.texts, self.matches = self.texts.unionByName(new), self.matches.unionByName(found.added)
        self.known = found.names
        plain = contains_join(names, self.texts, "name", "querytxt", ["query_id"])
        assert rows(found.current, *COLUMNS) == rows(plain, *COLUMNS)
        return rows(found.added, "query_id", "name")


def test_new_vanished_longer_and_returning_names(spark, log, names):
    store = Store(spark, log)
    assert store.run(names("a.b"), log((1, "from a.bc"), (2, "x"))) == [(1, "a.b")]
    assert store.run(names("a.b"), log((3, "a.b a.b"))) == [(3, "a.b")]
    assert store.run(names("a.b", "a.bc"), log()) == [(1, "a.bc")]  # a longer name: found in the old text
    assert store.run(names("a.bc"), log((4, "a.b and a.bc"))) == [(4, "a.bc")]  # a.b is gone
    assert store.run(names("a.b", "a.bc"), log((5, "a.b"))) == [(1, "a.b"), (3, "a.b"), (4, "a.b"), (5, "a.b")]  # and back
    assert store.run(names(), log((6, "a.b"))) == []
    assert store.run(names("q.r", None), log((None, "q.r"), (7, None), (8, "q.r"))) == [(None, "q.r"), (8, "q.r")]


def test_random_runs_equal_full_matching(spark, log, names):
    rng = random.Random(4)
    lot = [f"{a}.{b}" for a in ("s", "st", "t") for b in ("a", "ab", "b", "ba")]
    store, n = Store(spark, log), 0
    for _ in range(4):
        new = [(n + i, " ".join(rng.choice(lot) for _ in range(rng.randrange(4)))) for i in range(6)]
        n += len(new)
        store.run(names(*rng.sample(lot, rng.randrange(3, len(lot)))), log(*new))


def test_old_texts_are_not_read_without_a_new_name(spark, frame, log, names, tmp_path):
    log((1, "a.b")).write.parquet(str(tmp_path / "old"))
    log((2, "a.b")).write.parquet(str(tmp_path / "new"))
    old, new = (spark.read.schema("query_id bigint, querytxt string").parquet(str(tmp_path / p)) for p in ("old", "new"))
    known = frame("name string, since timestamp_ntz", ("a.b", RUN[1]), ("gone.x", RUN[1]))
    same = additions(names("a.b"), known, old, new, "querytxt", ["query_id"])
    assert all("/new/" in f for f in same.inputFiles()) and rows(same, "query_id") == [(2,)]
    more = additions(names("a.b", "a.c"), known, old, new, "querytxt", ["query_id"])
    assert any("/old/" in f for f in more.inputFiles()) and rows(more, "query_id") == [(2,)]


def test_a_second_run_with_the_same_stamp_adds_nothing(spark, log, names):
    first = matches_after(names("a.b"), log(), log((1, "a.b")), empty_target(spark, "query_matches"), empty_target(spark, "matched_names"), RUN[1])
    again = matches_after(names("a.b"), log((1, "a.b")), log(), first.added, first.names, RUN[1])
    assert rows(again.added) == [] and rows(again.current) == rows(first.current)
    assert increments.known_names(names("a.b", "a.b"), first.names, RUN[2]).count() == 1


def test_kept_matches_move_once_to_be_attributed(spark, frame, log, names):
    found = matches_after(names("s.t", "r.v"), log(), log((1, "s.t r.v")), empty_target(spark, "query_matches"), empty_target(spark, "matched_names"), RUN[1])
    known = frame(TARGETS["tables"], {"schema_table": "s.t", "table_name": "t", "schema_name": "s", "objectsrc": "internal_table", "most_recent": True})
    queries = frame(TARGETS["sql_queries"], {"query_id": 1, "querytxt": "s.t r.v"})
    used = deps.attribute_matches(found.current, queries, known, empty_target(spark, "object_dependencies"))
    plan = used._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(query_id") == 2  # narrow matches, and the log once
    assert rows(used, "query_id", "schema_table", "querytxt") == [(1, "s.t", "s.t r.v")]


def test_partitions_of_kept_matches_grow_with_their_number(spark, log, names, monkeypatch):
    store = Store(spark, log)
    store.run(names("a.b", "a.bc"), log(*((n, "a.bc") for n in range(30))))
    monkeypatch.setattr(matching, "DOTS_AT_ONCE", 10)
    found = matches_after(names("a.b", "a.bc"), store.texts, log((30, "a.bc")), store.matches, store.known, RUN[9])
    assert found.current.rdd.getNumPartitions() == 7  # 62 matches
    assert rows(found.current, "query_id", "name_length") == sorted((n, length) for n in range(31) for length in (3, 4))
