"""Token counts and packing against the tokenizers library."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import TESTDATA, TEXTS, documents, nothing
from tidemark.llm.common import byte_level, table
from tidemark.llm.packing import WordIds, pack, pieces_of
from tidemark.llm.token_counts import PreTokens, token_counts


def library(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids(tokenizer: Tokenizer, text: str | None) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark):
    tokenizer = library("byte_bpe_50k.json")
    got = token_counts(documents(spark)).collect()
    want = [(i, len((t or "").encode()), len(ids(tokenizer, t))) for i, t in enumerate(TEXTS)]
    want += [(None, 5, len(ids(tokenizer, "no id"))), (3, 1, 1)]
    assert sorted((r[:3] for r in got), key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_counts_of_the_tables(spark):
    tokenizer, docs = library("byte_bpe_50k.json"), table(spark, TESTDATA, "documents")
    got = {r.doc_id: r.n_tokens for r in token_counts(docs).collect()}
    assert got == {r.doc_id: len(ids(tokenizer, r.text)) for r in docs.collect()}
    assert token_counts(nothing(spark)).count() == 0


def test_counts_of_a_tail_that_is_joined(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.token_counts.HEAD", 3)
    tokenizer, docs = library("byte_bpe_50k.json"), table(spark, TESTDATA, "documents").limit(20)
    got = {r.doc_id: r.n_tokens for r in token_counts(docs).collect()}
    assert got == {r.doc_id: len(ids(tokenizer, r.text)) for r in docs.collect()}


LETTERS = st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs"]) | st.sampled_from(" '\n.,aàéß0Σİ"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(LETTERS)
def test_both_cutters_agree_with_the_library(text):
    for cutter, name in ((PreTokens(None), "byte_bpe_50k.json"),):
        base, pieces = cutter.of(text)
        assert base + sum(cutter.count(pieces)) == len(ids(library_of[name], text))
    data = word_ids.of(text)
    assert np.frombuffer(data, "<u4").tolist() == ids(library_of["word_bpe_49k.json"], text)


library_of = {name: library(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}
word_ids = WordIds(None)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" '\n\u0e01\u0627\u0938\u094d\U0001f600\u200d7٣"), max_size=60))
def test_texts_of_all_scripts_are_cut_and_never_encoded_whole(text):
    cutter = PreTokens(None)
    base, pieces = cutter.of(text)
    assert base == 0 and "".join(pieces) == text
    assert sum(cutter.count(pieces)) == len(ids(library_of["byte_bpe_50k.json"], text))


def test_no_key_gathers_a_row_of_every_document(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('word ', id) as text")
    plan = token_counts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce(piece" in plan
    texts = ["สวัสดี ครับ", "مرحبا بالعالم ٣", "नमस्ते दुनिया", "😀 ok 👩‍👩‍👧", "<|endoftext|> สวัสดี<|endoftext|>"]
    got = {r.doc_id: r.n_tokens for r in token_counts(documents(spark, texts)).collect() if r.doc_id is not None and r.doc_id != 3}
    assert got == {i: len(ids(library("byte_bpe_50k.json"), t)) for i, t in enumerate(texts) if i != 3}


def test_byte_spelling():
    pre = library_of["byte_bpe_50k.json"].pre_tokenizer
    for text in ("a", " a", "é", " ½", "\n\n", "日"):
        assert byte_level(text) == "".join(piece for piece, _ in pre.pre_tokenize_str(text))


@pytest.mark.parametrize("capacity", [4096, 100])
def test_pieces_fill_their_classes(capacity):
    for tokens in [*range(1, 3 * capacity, 7), capacity, 2 * capacity]:
        pieces = list(pieces_of(tokens, capacity))
        assert sum(length for length, _ in pieces) == tokens
        assert all(0 < length * k <= capacity for length, k in pieces)


def check_packing(rows, want: dict[tuple, list[list[int]]], capacity: int) -> float:
    """Every id of every document lies in one piece, sequences have no gaps; gives the share of padding."""
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    assert found.keys() == want.keys()
    for key, pieces in found.items():
        tokens = sum(len(x) for x in want[key])
        assert sum(p.length for p in pieces) == tokens
        if len(want[key]) == 1:
            pieces.sort(key=lambda p: p.start)
            assert b"".join(p.ids for p in pieces) == np.array(want[key][0], "<u4").tobytes()
            assert [p.start for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]]
            assert {p.doc_tokens for p in pieces} == {tokens}
    for pieces in sequences.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]]
        assert sum(p.length for p in pieces) <= capacity
    return 1 - sum(r.length for r in rows) / (capacity * len(sequences))


def test_packing_is_a_round_trip(spark):
    want = defaultdict(list)
    for row in documents(spark).collect():
        want[row.doc_id].append([*ids(library_of["word_bpe_49k.json"], row.text), 2])
    for capacity in (4096, 128):
        check_packing(pack(documents(spark), capacity=capacity).collect(), want, capacity)
    assert pack(nothing(spark)).count() == 0


def test_packing_of_the_tables_pads_little(spark):
    docs = table(spark, TESTDATA, "documents")
    want = {r.doc_id: [[*ids(library_of["word_bpe_49k.json"], r.text), 2]] for r in docs.collect()}
    assert check_packing(pack(docs).collect(), want, 4096) < 0.05
