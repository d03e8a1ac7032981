"""SimHash links, components, near-duplicates and top-k search against brute force."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import TESTDATA, documents, nothing
from tidemark.llm import topk
from tidemark.llm.common import table
from tidemark.llm.components import connected_components
from tidemark.llm.simhash import fingerprint, near_links, simhash_components, without_near_copies
from tidemark.llm.topk import top_k


class Groups(dict):
    """A union of nodes into groups named by their smallest."""

    def __missing__(self, node):
        self[node] = node
        return node

    def root(self, node):
        while self[node] != node:
            node = self[node]
        return node

    def tie(self, a, b):
        low, high = sorted((self.root(a), self.root(b)))
        self[high] = low


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_definition():
    for text in (None, "", " \n", "a", "A b", "Éa b c d", "a\u00a0b c", "x y z " * 100):
        assert fingerprint(text) == plain_fingerprint(text)


def test_long_texts_are_taken_in_parts(monkeypatch):
    text = " ".join(f"w{n % 977}" for n in range(5000))
    whole = fingerprint(text)
    monkeypatch.setattr("tidemark.llm.simhash.PART_BYTES", 100)
    monkeypatch.setattr("tidemark.llm.simhash.PART_WORDS", 313)
    assert fingerprint(text) == whole == plain_fingerprint(text)


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(n, n + 1) for n in range(1000, 1100)] + [(7, 7)]
    groups = Groups()
    for a, b in edges:
        groups.tie(a, b)
    got = dict(connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {n: groups.root(n) for n in groups if n != groups.root(n) or n in got}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("group", [1, 8, 64])
def test_links_connect_what_is_within_two_bits(spark, group):
    rng = random.Random(group)
    centres = [rng.getrandbits(64) for _ in range(12)] + [0]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centres for _ in range(25)}
    fps |= {rng.getrandbits(64) for _ in range(100)}
    groups = Groups()
    for a, b in combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= 2:
            groups.tie(a, b)
    found = Groups()
    links = near_links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), group=group).collect()
    for u, v in links:
        assert ((u ^ v) & (2**64 - 1)).bit_count() <= 2
        found.tie(u % 2**64, v % 2**64)
    assert {f: found.root(f) for f in fps} == {f: groups.root(f) for f in fps}


def test_components_of_documents(spark):
    docs = table(spark, TESTDATA, "documents")
    rows = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    groups = Groups()
    for a, b in combinations(rows, 2):
        if (rows[a] ^ rows[b]).bit_count() <= 2:
            groups.tie(a, b)
    got = simhash_components(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{f:016x}", groups.root(d)) for d, f in rows.items()}


def test_awkward_documents_have_components(spark):
    got = simhash_components(documents(spark)).collect()
    assert len(got) == documents(spark).count()
    zero = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {0}  # null, empty and white space link to each other
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert {r.component_id for r in got if r.doc_id in (4, 5)} == {4}
    assert simhash_components(nothing(spark)).count() == 0


def test_one_of_each_group_stays_with_all_columns(spark):
    docs = documents(spark)
    stay = without_near_copies(docs)
    assert stay.columns == docs.columns
    ids = [r.doc_id for r in stay.collect()]
    assert 0 in ids and not {1, 2, 5} & set(ids) and 4 in ids and None in ids
    assert without_near_copies(nothing(spark)).count() == 0


def test_rows_and_not_ids_are_copies(spark):
    rows = [(5, "a b c d e"), (5, "v w x y z"), (1, "A b c  d e"), (2, "v W x y z"), (2, "v W x y z"), (3, "v w x y z"),
            (None, "k l m n o"), (4, "p q r s t"), (4, "p q r s u"), (None, "p q r s t")]
    docs = spark.createDataFrame([(t, i, "h") for i, t in rows], "text string, doc_id long, h1 string")
    got = sorted(((r.doc_id, r.text, r.h1) for r in without_near_copies(docs).collect()), key=str)
    assert got == sorted([(1, "A b c  d e", "h"), (2, "v W x y z", "h"), (None, "k l m n o", "h"), (4, "p q r s t", "h"), (4, "p q r s u", "h")], key=str)


@pytest.mark.parametrize(("step", "block"), [(1, 256), (768, 4)])
def test_search_equals_brute_force(spark, monkeypatch, step, block):
    monkeypatch.setattr("tidemark.llm.topk.BLOCK", block)
    monkeypatch.setattr("tidemark.llm.topk.SLICE", 16)
    monkeypatch.setattr("tidemark.llm.topk.BATCH", 5)
    rng = np.random.default_rng(3)
    vectors = [(i * step, rng.normal(0, 0.3, 12).tolist(), "x") for i in range(400)]
    vectors += [(400, None, "x"), (450, [float("nan")] * 12, "x"), (500, [None, 1.0], "x"), (550, [1.0], "x"), (600, [], "x"),
                (None, [1.0] * 12, "x"), (7, [0.5] * 12, "x"), (650, [float("inf")], "x"), (700, [1e300], "x"),
                (50, [0.1] * 12, "x"), (50, [0.9] * 12, "x"), (50, [0.9] * 12, "x")]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, slice string")
    rows = [
        (i, [int(np.floor(np.float64(256) * x)) for x in v])
        for i, v, _ in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and max(map(abs, v), default=0) < 1e18
    ]
    want = Counter()
    for n, (q, v) in enumerate(rows):
        if q % 50 == 0:  # each row asks, and is a candidate of the rows that share its id
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for m, (i, w) in enumerate(rows) if m != n)
            want.update((q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1))
    got = Counter((r.query_id, r.rank, r.vec_id, r.score) for r in top_k(df.where("vec_id is null or vec_id <> 700")).collect())
    assert got == want
    assert top_k(df).where("query_id = 700").count() == 5  # beyond double precision, but no failure
    assert top_k(df.where("false")).count() == 0


def test_rows_are_sliced_by_order_and_not_by_id(spark):
    rows = spark.range(0, 40000 * 768, 768).repartition(7).selectExpr("id as vec_id", "array(1L) as weights")
    found = topk.numbered(rows)
    assert found.selectExpr("min(row)", "max(row)", "count(distinct row)").first()[:] == (0, 39999, 40000)


def test_search_prunes_blocks_and_keeps_results(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(0)
    docs = pd.DataFrame({"row": range(1000), "vec_id": range(1000), "weights": list(rng.integers(-99, 99, (1000, 8)))})
    queries = pd.DataFrame({"query_row": [0, 500], "query_id": [0, 500], "weights": list(docs["weights"].iloc[[0, 500]])})
    by_block = topk.search_slice(docs, queries, 5, block=16)
    assert by_block.equals(topk.search_slice(docs, queries, 5, block=1000))
