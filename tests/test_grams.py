"""Names of any form in texts, against Python's own search."""

import random

import pytest

from tests.conftest import rows
from tidemark.operators import grams
from tidemark.operators.grams import anchors, contains_join_plain
from tidemark.operators.joins import BROADCAST_BYTES_CONF
from tidemark.operators.matching import contains_join


@pytest.fixture(params=["broadcast", "shuffled"])
def join_size(request, spark):
    if request.param == "shuffled":
        spark.conf.set(BROADCAST_BYTES_CONF, "0")
    yield request.param
    spark.conf.unset(BROADCAST_BYTES_CONF)


@pytest.fixture
def match(frame):
    def build(names, texts):
        return contains_join_plain(frame("name string", *((n,) for n in names)), frame("id int, text string", *enumerate(texts)))

    return build


def plain(names, texts):
    return sorted((i, n, t.index(n) + 1, len(n)) for i, t in enumerate(texts) if t for n in set(names) if n and n in t)


NAMES = ["orders", "order", "o", "table_orders", "table_old", "é", "日本語の名前です", "👩‍👩‍👧x", "a b", "s.t", "", None, "x" * 40, "a\nb", "%_", "(?s)", "orders"]
TEXTS = ["from orders o", "table_orders, table_old", None, "", "O ORDERS", "👩‍👩‍👧x then 日本語の名前です!", "a b a\nb", "s.t s_t", "y" + "x" * 41, "100%_(?s)", "😀é"]


def test_names_of_any_form(match, join_size):
    assert rows(match(NAMES, TEXTS)) == plain(NAMES, TEXTS)


def test_random_texts_over_small_blocks(match, monkeypatch):
    monkeypatch.setattr(grams, "BLOCK", 16)
    rng = random.Random(3)
    word = lambda most: "".join(rng.choice("ab😀") for _ in range(rng.randrange(1, most)))
    names, texts = [word(14) for _ in range(60)], [word(120) for _ in range(40)]
    assert rows(match(names, texts)) == plain(names, texts)


def test_equals_the_join_of_names_with_dots(frame, match):
    names, texts = ["a.t", "da.t", "s.tab", "s.table", "s.table_1"], ["from da.t, s.table_1", "a.t s.tab", "sa.t.s.table"]
    dotted = contains_join(frame("name string", *((n,) for n in names)), frame("id int, text string", *enumerate(texts)))
    assert rows(match(names, texts)) == rows(dotted)


def test_ids_may_be_null_or_repeat(frame):
    texts = frame("id int, text string", (None, "abc"), (None, "abc"), (1, "xabc"), (1, "abc"))
    assert rows(contains_join_plain(frame("name string", ("abc",)), texts), "id", "match_location") == [(None, 1), (1, 1), (1, 2)]
    nothing = frame("name string")
    assert contains_join_plain(nothing, texts).count() == contains_join_plain(frame("name string", ("abc",)), texts.where("false")).count() == 0


def test_a_stretch_of_most_names_is_no_key(spark, frame):
    """One stretch in nearly all names, and in all texts: the names meet the places that hold their own part only."""
    names = [f"warehouse_{n:05d}" for n in range(3000)]
    chosen = anchors(frame("name string", *((n,) for n in names)))
    most = chosen.groupBy("anchor").count().agg({"count": "max"}).first()[0]
    assert most <= 10 and chosen.count() == 3000
    texts = frame("id int, text string", *((i, f"from warehouse_{i:05d} join warehouse_99999") for i in range(500)))
    found = contains_join_plain(frame("name string", *((n,) for n in names)), texts)
    assert rows(found, "id", "name") == [(i, names[i]) for i in range(500)]


def test_a_long_text_is_searched_whole(match):
    text = "lorem ipsum " * 100_000 + "needle_name" + " dolor" * 10
    assert rows(match(["needle_name", "dolor"], [text])) == plain(["needle_name", "dolor"], [text])
