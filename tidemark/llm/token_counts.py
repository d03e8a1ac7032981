"""Tokens per document without making the ids: pieces are counted once per distinct pre-token.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens as its pre-tokens
together. The first pass over the texts lists the distinct pre-tokens with their frequency, and
the tokenizer library counts the pieces of each once. The second pass multiplies each document's
own pre-token frequencies with those counts. The most frequent pre-tokens, a fixed number of
bounded length, reach the tasks as a broadcast table; the others are joined by an ordinary
shuffle join and are rare, so the shuffle carries only the tail of the vocabulary.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LATIN, PLAIN, Rows, byte_level, kept, load_tokenizer, row_key, rows_of

#: Distinct pre-tokens whose counts are broadcast, and the most characters of such a pre-token.
HEAD, HEAD_CHARS = 100_000, 64
#: Distinct pre-tokens a task holds before it hands them on.
FLUSH = 200_000

FREQUENCIES = pa.schema([("piece", pa.string()), ("n", pa.int64())])
COUNTS = pa.schema([("piece", pa.string()), ("n", pa.int64()), ("tokens", pa.int64())])
PARTS = pa.schema([
    ("_row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
    ("base", pa.int64()), ("piece", pa.string()), ("n", pa.int64()),
])


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PreTokens:
    """Cuts texts into pre-tokens as the library does for a byte-level BPE with the usual pattern."""

    #: That pattern for texts in Latin script, in the terms of Python's own engine.
    LATIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]++| ?[0-9]++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+")

    def __init__(self, path: str | None):
        import public_tokenizers

        self.tokenizer = load_tokenizer(path or byte_bpe_path())
        if self.tokenizer.normalizer is not None or "ByteLevel" not in str(self.tokenizer.pre_tokenizer):
            raise ValueError("token counts by pre-token need a byte-level BPE without a normalizer")
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None

    def of(self, text: str) -> tuple[int, list[str]]:
        """Tokens counted right away (special strings), and the pre-tokens."""
        if LATIN.fullmatch(text):
            cut = self.LATIN.findall
        elif PLAIN.fullmatch(text):
            cut = self.pattern.findall
        else:
            cut = self.pieces
        if self.special is None or not self.special.search(text):
            return 0, cut(text)
        return len(self.special.findall(text)), [piece for part in self.special.split(text) for piece in cut(part)]

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text in any script, cut by the library itself."""
        return [text[start:end] for _, (start, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, pieces: list[str]) -> list[int]:
        return [len(self.tokenizer.model.tokenize(byte_level(piece))) for piece in pieces]


def piece_counts(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(piece, n, tokens): every distinct pre-token of all texts, its frequency and its number of tokens."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen, out = PreTokens(path), Counter(), Rows(FREQUENCIES)

        def flushed():
            for piece, n in seen.items():
                out.add(piece, n)
                if out.full():
                    yield out.take()
            seen.clear()
            yield out.take()

        for (text_,) in rows_of(batches):
            seen.update(cut.of(text_ or "")[1])
            if len(seen) > FLUSH:
                yield from flushed()
        yield from flushed()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = PreTokens(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                tokens = cut.count(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(tokens, pa.int64())], schema=COUNTS)

    pieces = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(frequencies, "piece string, n long")
    pieces = pieces.groupBy("piece").agg(F.sum("n").alias("n"))
    return pieces.mapInArrow(counted, "piece string, n long, tokens long")


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows from some frequency ``n`` on, as many as there can be up to ``most``; a few hundred numbers decide."""
    step = F.floor(8 * F.log2("n")).alias("step")
    steps = counts.groupBy(step).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("step")).collect()
    least, rows = None, 0
    for found in steps:
        rows += found["rows"]
        if rows > most:
            break
        least = found["step"]
    return counts.where(F.lit(False) if least is None else F.floor(8 * F.log2("n")) >= least)


def token_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = 512
) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``).

    A null text counts as empty: no bytes, no tokens. Rows that repeat an id each get their own
    row; a null id stays null. Other columns of the input are not read. ``path`` names a tokenizer
    file that every executor can read; None takes the public byte-level BPE of 50k entries.
    """
    spark = docs.sparkSession
    counts = kept(piece_counts(docs, text, path))
    head = most_frequent(counts.where(F.length("piece") <= HEAD_CHARS), HEAD).select("piece", "tokens").toPandas()
    known = spark.sparkContext.broadcast(dict(head.itertuples(index=False, name=None)))

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, lookup, out = PreTokens(path), known.value, Rows(PARTS)
        for number, (id_, text_) in enumerate(rows_of(batches)):
            text_ = text_ or ""
            base, pieces = cut.of(text_)
            row = row_key(number)
            for piece, n in Counter(pieces).items():
                tokens = lookup.get(piece)
                if tokens is None:
                    out.add(row, None, None, None, piece, n)
                else:
                    base += tokens * n
            out.add(row, id_, len(text_.encode()), base, None, None)
            if out.full():
                yield out.take()
        yield out.take()

    parts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = parts.mapInArrow(second_pass, "_row long, doc_id long, n_bytes long, base long, piece string, n long")
    # a document's own row meets no piece: a key of its own keeps these rows from sharing one partition
    key = F.coalesce("piece", F.concat(F.lit("\u0000"), F.col("_row").cast("string"))).alias("key")
    tokens = parts.select("_row", "doc_id", "n_bytes", "base", "n", key).join(counts.select(F.col("piece").alias("key"), "tokens"), "key", "left")
    return (
        tokens.groupBy("_row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.coalesce(F.col("base"), F.col("n") * F.col("tokens"))).alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
