"""SimHash fingerprints and near-duplicates by deletion-variant signatures.

Two fingerprints within ``radius`` bits agree, in at least one of radius // 2 + 1 segments, up to a
single bit. So each segment is indexed once per bit with that bit taken out (a one-wildcard
variant): fingerprints that share a variant are candidates, and the exact distance decides.

Segments that very many fingerprints share would make groups of all pairs. Fingerprints with such a
segment find the others, which are in small groups, by the same join; links between two of them
come from variants of the whole fingerprint: within two bits of each other means having a common
neighbour within one bit, so every fingerprint is tied to each of its one-bit neighbours, and no
pair is ever listed. The links' components are the same either way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rows, kept, rows_of
from tidemark.llm.components import connected_components

BITS = 64
#: Fingerprints that may share a segment before its links are found by whole fingerprints.
GROUP = 64
#: Bytes of a text from which on its words are taken part by part.
PART_BYTES, PART_WORDS = 4_000_000, 200_000
WORD = re.compile(rb"[^ \t-\r]+")

FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
KEYED = pa.schema([*FINGERPRINTS, ("h1", pa.int64()), ("h2", pa.int64())])


def shingles(text: str | None, words: int) -> Iterator[list[bytes]]:
    """The shingles of a text in parts of bounded size; lower case of A-Z only, words between ASCII white space."""
    data = (text or "").encode().lower()
    if len(data) <= PART_BYTES:
        parts: Iterator[list[bytes]] = iter([data.split()])
    else:
        found = WORD.finditer(data)

        def blocks(last: tuple = ()) -> Iterator[list[bytes]]:
            while block := [m[0] for _, m in zip(range(PART_WORDS), found, strict=False)]:
                yield [*last, *block]
                last = (*last, *block)[len(last) + len(block) - words + 1 :] if words > 1 else ()

        parts = blocks()
    for part in parts:
        if len(part) >= words:
            yield list(map(b" ".join, zip(*(part[i:] for i in range(words)), strict=False)))
        elif part:
            yield [b" ".join(part)]


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text; 0 if it has no word."""
    digest, n, ones = partial(xxhash.xxh64_intdigest, seed=seed), 0, np.zeros(BITS, np.int64)
    for part in shingles(text, words):
        hashes = np.fromiter(map(digest, part), np.uint64, len(part))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def row_key(doc_id: str, text: str) -> list[Column]:
    """Columns h1 and h2: 128 bits that name a row by its id and text; a null text counts as empty."""
    parts = [F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(*reversed(parts), F.lit(1)).alias("h2")]


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, keyed: bool = False
) -> DataFrame:
    """(doc_id, fp): one row per input row, the fingerprint as a signed long; with :func:`row_key` if ``keyed``."""
    schema = KEYED if keyed else FINGERPRINTS

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for id_, text_, *key in rows_of(batches):
            fp = fingerprint(text_, words)
            out.add(id_, fp - (1 << BITS) if fp >> (BITS - 1) else fp, *key)
            if out.full():
                yield out.take()
        yield out.take()

    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")]
    rows = docs.select(*columns, *(row_key(doc_id, text) if keyed else []))
    return rows.mapInArrow(of, ", ".join(f"{name} long" for name in schema.names))


def segments(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of the radius // 2 + 1 segments."""
    n = radius // 2 + 1
    ends = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _segment(first: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))


def _variants(fps: DataFrame, radius: int) -> DataFrame:
    """``fps`` with a row per variant: the segment's number, the bit left out and the other bits in one long."""
    keys = []
    for number, (first, width) in enumerate(segments(radius)):
        value = _segment(first, width)
        for bit in range(width):
            rest = value.bitwiseAND(F.lit(~(1 << bit) & ((1 << width) - 1)))
            keys.append(rest.bitwiseOR(F.lit(number * BITS + bit << 48)))
    return fps.withColumn("key", F.explode(F.array(*keys)))


def near_links(fps: DataFrame, radius: int = 2, group: int = GROUP) -> DataFrame:
    """(u, v): links between distinct fingerprints (``fps``: fp) whose components are those of all pairs within ``radius``.

    Pairs of which one is in small groups only are listed exactly; the others are tied through
    common neighbours, which is exact for a radius of 2.
    """
    if radius != 2:
        raise ValueError("common neighbours within one bit stand for a distance of two")
    parts = F.array(*[
        F.struct(F.lit(n).alias("segment"), _segment(*s).alias("value")) for n, s in enumerate(segments(radius))
    ])
    parts = fps.select("fp", F.explode(parts).alias("part")).select("fp", "part.segment", "part.value")
    common = kept(parts.groupBy("segment", "value").count().where(F.col("count") > group).drop("count"))
    if common.isEmpty():
        rare = fps.withColumn("crowded", F.lit(False))
        everyone, crowded = rare, None
    else:
        crowded = kept(parts.join(common, ["segment", "value"], "left_semi").select("fp").distinct())
        everyone = kept(fps.join(crowded.withColumn("crowded", F.lit(True)), "fp", "left").fillna(False, "crowded"))
        rare = everyone.where("not crowded")
    left = _variants(rare, radius).select(F.col("fp").alias("u"), "key")
    right = _variants(everyone, radius).select(F.col("fp").alias("v"), "crowded", "key")
    distance = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    near = (left["key"] == right["key"]) & (distance <= radius) & ((F.col("u") < F.col("v")) | F.col("crowded"))
    links = left.join(right, near).select("u", "v").distinct()
    if crowded is None:
        return links
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(BITS)])
    neighbours = crowded.select("fp", F.explode(flips).alias("key"))
    first = neighbours.groupBy("key").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ties = neighbours.join(first, "key").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()
    return links.unionByName(ties)


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable.

    Documents link when their fingerprints differ in at most ``radius`` bits. A text that is null or
    without words has fingerprint zero and links like any other. Rows that repeat an id or a text
    each get a row. A null doc_id stays null and names no component unless all its members are null.
    Other columns are not read; an empty table gives no rows.
    """
    rows = kept(fingerprints(docs, doc_id, text, words))
    first = kept(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    components = kept(connected_components(near_links(first.select("fp"), radius)))
    named = first.join(components, first["fp"] == components["node"], "left")
    named = named.select("fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    lookup = named.join(smallest, "component").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(lookup, "fp").select("doc_id", hexed, "component_id")


def without_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """``docs``, all columns, with one row of each component of :func:`simhash_components`.

    The row with the smallest id stays, null ids last; among texts that share this id, the one whose
    hash comes first; of rows equal in id and text, any one. So rows count, not ids: a clean text stays
    when another text of the same id is a copy. Texts without words (null too) form one group with
    fingerprint zero. An empty table stays empty; extra columns keep their names and values.
    """
    rows = kept(fingerprints(docs, doc_id, text, words, keyed=True))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h1", "h2")
    first = kept(rows.groupBy("fp").agg(F.min(order).alias("first")))
    components = kept(connected_components(near_links(first.select("fp"), radius)))
    named = first.join(components, first["fp"] == components["node"], "left")
    named = named.select("first", F.coalesce("component", "fp").alias("component"))
    heads = named.groupBy("component").agg(F.min("first").alias("head")).select("head.h1", "head.h2")
    whole = docs.select(F.struct("*").alias("doc"), *row_key(doc_id, text))
    return whole.join(heads, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).select("doc.*")
