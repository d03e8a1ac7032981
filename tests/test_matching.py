import random

import pytest

from tests.conftest import rows, ts
from tidemark.operators import dependencies as deps
from tidemark.operators import matching
from tidemark.operators.joins import BROADCAST_BYTES_CONF, lookup_join, not_in
from tidemark.operators.matching import contains_join, longest_match
from tidemark.sources import INPUTS, TARGETS


@pytest.fixture(params=["broadcast", "shuffled"])
def join_size(request, spark):
    """Run a test with lookups below and above the broadcast limit."""
    if request.param == "shuffled":
        spark.conf.set(BROADCAST_BYTES_CONF, "0")
    yield request.param
    spark.conf.unset(BROADCAST_BYTES_CONF)


@pytest.fixture
def match(frame):
    def build(names, texts):
        return contains_join(
            frame("name string", *((n,) for n in names)), frame("id int, text string", *enumerate(texts))
        )

    return build


def brute_force(names, texts):
    return sorted(
        (i, n, t.index(n) + 1, len(n)) for i, t in enumerate(texts) if t is not None for n in set(names) if n and n in t
    )


def test_a_name_inside_a_longer_name_is_a_hit_of_its_own(match):
    assert rows(match(["a.t", "da.t"], ["from da.t"])) == [(0, "a.t", 7, 3), (0, "da.t", 6, 4)]


def test_the_longest_name_at_a_place_wins_and_later_uses_of_the_short_one_are_lost(match):
    found = match(["a.b", "a.bc"], ["a.bc join a.b", "a.b join a.bc"])
    assert rows(longest_match(found, ["id"])) == [(0, "a.bc", 1, 4), (1, "a.b", 1, 3), (1, "a.bc", 10, 4)]


def test_odd_names_and_texts(match, join_size):
    names = [".x", "a.", "a.b.c", "b.c", "é.ü", "😀a.b", None, "a.b"]
    texts = ["a.b.c", ".x", "a.", "no dot", "", None, "éé.üü a.b.cd", "x😀a.b\n.x", "A.B", "....", "a..x"]
    assert rows(match(names, texts)) == brute_force(names, texts)


def test_null_and_repeated_ids(frame, join_size):
    texts = frame(
        "id int, text string", (1, "from a.t x a.t"), (None, "from a.t"), (2, "select a.t"), (2, "select 1"), (2, "a.t"), (2, "a.t"),
        (3, "b.t"), (None, None),
    )
    found = contains_join(frame("name string", ("a.t",)), texts)
    assert rows(found) == [(None, "a.t", 6, 3), (1, "a.t", 6, 3), (2, "a.t", 1, 3), (2, "a.t", 8, 3)]


def test_a_very_long_text_with_very_many_hits(match, join_size):
    names = ["s.t", "s.u", "other.t"]
    text = "join s.t, äö s.tt " * 25_000 + "s.u"
    assert rows(match(names, [text])) == [(0, "s.t", 6, 3), (0, "s.u", len(text) - 2, 3)]


def test_texts_stay_where_they_are(frame, join_size):
    texts = frame("id int, text string", (1, "from a.t x a.t"))
    plan = contains_join(frame("name string", ("a.t",)), texts)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line or "Sort [" in line]
    assert moved and not any("_text#" in line for line in moved)


def test_no_names_no_matches(match):
    assert match([None], ["a.b"]).count() == 0


def test_names_without_a_dot_are_refused(match):
    with pytest.raises(ValueError, match="no dot"):
        match(["ab"], ["ab"])


def test_random_texts_against_brute_force(match, join_size):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ab.") for _ in range(rng.randrange(1, n)))
    names = list({w for w in (word(7) for _ in range(300)) if "." in w})
    texts = [word(60) for _ in range(120)]
    assert rows(match(names, texts)) == brute_force(names, texts)


def test_one_schema_with_most_names_and_a_long_text(match):
    names = [f"hot.t{n}" for n in range(2000)] + ["cold.x"]
    texts = [" ".join(f"hot.t{n}" for n in range(0, 2000, 7)) + " cold.x" + " pad" * 5000 + " hot.t1999", "cold.x"]
    assert rows(match(names, texts)) == brute_force(names, texts)


def test_the_matching_plan_has_no_pairwise_join(match):
    plan = match(["a.b", "a.bc"], ["a.bc"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange hashpartitioning(id") == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_equals_a_plain_join(frame, join_size, how):
    facts = frame("k int, v int", *((n % 5 if n % 3 else 0, n) for n in range(90)), (None, 90))
    lookup = frame("k int, w string", (0, "zero"), (1, "one"), (1, "uno"), (9, "nine"), (None, "none"))
    assert rows(lookup_join(facts, lookup, ["k"], how)) == rows(facts.join(lookup, ["k"], how))


def test_not_in_follows_sql(spark, frame, join_size):
    facts = frame("k int", (1,), (2,), (None,))
    for other in ([], [(2,)], [(2,), (None,)]):
        df = frame("k int", *other)
        facts.createOrReplaceTempView("f")
        df.createOrReplaceTempView("o")
        assert rows(not_in(facts, df, "k")) == rows(spark.sql("SELECT * FROM f WHERE k NOT IN (SELECT k FROM o)"))


# --- view and query edges ---------------------------------------------------------------------------

TABLE = "schema_table string, schema_name string, table_name string, objectsrc string, table_id int, most_recent boolean"


@pytest.fixture
def tables(frame):
    def build(*entries):
        full = [(n, *n.split(".", 1), src, i, recent) for n, src, i, recent in entries]
        return frame(TABLE, *full)

    return build


@pytest.fixture
def log(frame):
    def build(*texts):
        at = ts("2024-01-01 10:00:00")
        return frame(
            TARGETS["sql_queries"],
            *({"query_id": n, "querytxt": t, "starttime": at, "usename": "u"} for n, t in enumerate(texts, 1)),
        )

    return build


def edge(view, source, table_id=-1, oid=-1):
    return (view, source, "spectrum_table", table_id, oid, "view")


INSIDE, OUTSIDE = "internal_table", "spectrum_table"


def test_view_dependency_goes_through_the_rule(frame):
    classes = frame(INPUTS["pg_class"], (1, "t", "r", 10), (2, "v", "v", 11), (3, "w", "v", 99), (4, "cat", "r", 12))
    spaces = frame(INPUTS["pg_namespace"], (10, "s"), (11, "rpt"), (12, "pg_catalog"))
    depends = frame(
        INPUTS["pg_depend"],
        (100, 1, "n"), (100, 1, "n"), (100, 2, "i"), (100, 2, "n"), (100, 4, "n"),
        (101, 2, "n"), (101, 3, "i"), (102, 1, "i"), (103, 1, "n"),
    )
    found = deps.view_dependency(classes, depends, spaces)
    assert rows(found) == [
        (1, "s", "t", 2, "rpt", "v"), (2, "rpt", "v", 3, None, "w"), (4, "pg_catalog", "cat", 2, "rpt", "v"),
    ]
    assert rows(deps.internal_view_edges(found), "src_schema_table", "dependent_schema_objectname", "dependent_oid") == [
        ("rpt.v", None, 3), ("s.t", "rpt.v", 2),
    ]


def test_external_edges_take_the_view_id_only_where_an_internal_edge_has_it(frame, tables, join_size):
    views = frame(INPUTS["view_definitions"], ("rpt", "v", "from x.ab"), ("rpt", "w", "from x.a, x.ab"), ("rpt", "z", "from s.t"))
    known = tables(("x.a", OUTSIDE, -1, True), ("x.ab", OUTSIDE, -1, True), ("x.old", OUTSIDE, -1, False), ("s.t", INSIDE, 1, True))
    internal = frame("table_id int, src_schema_table string, dependent_oid int, dependent_schema_objectname string",
                     (1, "s.t", 7, "rpt.v"), (2, "s.u", 7, "rpt.v"))
    external = deps.external_view_edges(views, known, internal)
    assert rows(deps.object_dependencies(internal, external)) == [
        ("rpt.v", "s.t", INSIDE, 1, 7, "view"), ("rpt.v", "s.u", INSIDE, 2, 7, "view"),
        ("rpt.v", "x.ab", OUTSIDE, -1, 7, "view"), ("rpt.w", "x.a", OUTSIDE, -1, -1, "view"),
        ("rpt.w", "x.ab", OUTSIDE, -1, -1, "view"),
    ]


def test_dependency_lookup_is_ordered(frame):
    edges = frame(TARGETS["object_dependencies"], edge("r.v", "x.b"), edge("r.v", "x.a"), edge("r.vv", "x.c"))
    assert [r.src_schema_table for r in deps.dependency_lookup(edges, "r.v").collect()] == ["x.a", "x.b"]


def both_ways(queries, tables, edges):
    """Pairs found by the narrow steps one by one, and by the combined operator."""
    narrow = longest_match(deps.query_text_match(queries, tables, edges), ["query_id"], "schema_table_length")
    steps = rows(deps.query_dependencies(narrow, tables, queries))
    assert steps == rows(deps.attribute_queries(queries, tables, edges))
    return sorted((r[4], r[2]) for r in steps)


def test_queries_use_current_tables_and_what_views_read(frame, tables, log, join_size):
    known = tables(("s.t", INSIDE, 1, True), ("s.t", INSIDE, 1, False), ("s.gone", INSIDE, 2, False), ("x.e", OUTSIDE, -1, True))
    edges = frame(TARGETS["object_dependencies"], edge("r.v", "x.e"), edge("r.v", "s.t", 1), edge("r.v1", "s.t", 1),
                  edge("r.w", "r.v"), edge("r.q", None))
    queries = log("from s.t and s.t", "from s.gone", "from r.v", "from r.v1", "from r.w", "from r.q", None)
    assert both_ways(queries, known, edges) == [(1, "s.t"), (3, "s.t"), (3, "x.e"), (4, "s.t")]


def test_random_logs_both_ways_and_by_brute_force(frame, tables, log):
    rng = random.Random(3)
    names = [f"{s}.{t}" for s in ("a", "ba", "c") for t in ("t", "ta", "tab", "u")]
    known = tables(*((n, INSIDE, i, True) for i, n in enumerate(names)))
    views = [f"r.v{n}" for n in range(12)]
    pairs = [(v, rng.choice([*names, "a.none"])) for v in views for _ in range(2)]
    edges = frame(TARGETS["object_dependencies"], *(edge(v, s) for v, s in pairs))
    texts = [" join ".join(rng.choice(names + views + ["x.none"]) for _ in range(rng.randrange(1, 6))) for _ in range(200)]

    expected = set()
    for q, text in enumerate(texts, 1):
        hits = {(n, text.find(n)) for n in names + views if n in text}
        longest = {n for n, at in hits if len(n) == max(len(m) for m, other in hits if other == at)}
        targets = {n for n in names if n in longest} | {s for v, s in pairs if v in longest}
        expected |= {(q, t) for t in targets if t in names}
    assert both_ways(log(*texts), known, edges) == sorted(expected)


def test_no_wide_column_moves_before_the_last_join(frame, tables, log):
    known = tables(("s.t", INSIDE, 1, True))
    edges = frame(TARGETS["object_dependencies"], edge("r.v", "s.t"))
    plan = deps.attribute_queries(log("s.t"), known, edges)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
    assert plan.count("Exchange hashpartitioning(query_id") == 2  # narrow matches, and the log once


def test_partitions_of_matches_grow_with_the_dots(frame, monkeypatch):
    names = frame("name string", ("a.b",), ("a.bc",))
    texts = frame("id bigint, text string", *((n, "a.bc x.y") for n in range(50)))
    monkeypatch.setattr(matching, "DOTS_AT_ONCE", 10)
    found = matching.contains_join(names, texts)
    assert found.rdd.getNumPartitions() == 10
    assert found.groupBy("name").count().orderBy("name").collect() == [("a.b", 50), ("a.bc", 50)]
