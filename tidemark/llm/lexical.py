"""Ranked lexical search over a length-stratified index.

A document's score depends on its length through one whole number, the normaliser m. Documents of equal m form a stratum, and
there a term's impact depends on its frequency alone. So the index holds, per stratum, the postings of each term by frequency,
and an impact is computed once per frequency. The greatest frequency of each term bounds what a stratum can
score for an item. The strata with the highest bounds are visited first and give each item a k-th score; of the
others only those whose bound reaches it are scored, and each task raises the k-th score further as it goes.

A stratum that holds very many documents, or postings, is cut into blocks by row, so no task depends on how often a length occurs.
Postings are kept for terms of the items alone. Items are taken in batches of a bounded size; each batch reads the texts once.
All numbers are whole and below 2^53, so products of double matrices are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, rows_of, scratch

#: Documents and postings of a block of a stratum.
BLOCK, POSTINGS = 512, 200_000
#: Bytes of items that travel to the tasks at once; more take further passes.
ITEM_BYTES = 4_000_000
#: Distinct terms of items that are scored together.
TERMS_AT_ONCE = 4096
#: Blocks that are visited first for each item.
FIRST = 8
#: Stands for a null id, so that it sorts last.
NO_ID = 2**63 - 1

#: Digits and letters stay, A-Z in lower case; other characters below 0x80 separate; what is above stays.
SPELLING = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

FORWARD = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32())),
])
INDEX = "m long, part long, docs array<long>, terms array<int>, tfs array<int>, places array<int>"
BOUNDS = pa.schema([("item", pa.int32()), ("m", pa.int64()), ("part", pa.int64()), ("bound", pa.float64())])
HITS = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return (text or "").encode().translate(SPELLING).split()


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, tfs): each document's number of terms, and the frequencies of those in ``vocabulary``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            ids, sizes, terms, tfs, ends = [], [], [], [], [0]
            for id_, text_ in rows_of(iter([batch])):
                words = terms_of(text_)
                if not words:
                    continue
                found = Counter(map(number, words))
                found.pop(None, None)
                ids.append(NO_ID if id_ is None else id_)
                sizes.append(len(words))
                terms.extend(found.keys())
                tfs.extend(found.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], schema=FORWARD)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.where("text is not null").mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>")


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """One block of a stratum: its documents, and postings by term, then frequency."""
    rows = rows.sort_values("doc_id", kind="stable")
    sizes = [len(t) for t in rows["terms"]]
    terms = np.concatenate([np.asarray(t, np.int32) for t in rows["terms"]])
    tfs = np.concatenate([np.asarray(t, np.int32) for t in rows["tfs"]])
    order = np.lexsort((-tfs, terms))
    places = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)[order]
    first = rows.iloc[0]
    return pd.DataFrame({
        "m": [first["m"]], "part": [first["part"]], "docs": [rows["doc_id"].to_numpy(np.int64)],
        "terms": [terms[order]], "tfs": [tfs[order]], "places": [places],
    })


def stratified_index(forward: DataFrame, documents: int, length: int) -> DataFrame:
    """The blocks of all strata. One row per distinct m is broadcast: at most 50 times the longest by the mean length."""
    m = F.lit(50) + F.expr(f"(50L * n * {documents}L) div {length}L")
    strata = forward.withColumn("m", m).withColumn("row", F.monotonically_increasing_id())
    parts = strata.groupBy("m").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(F.size("terms")) / POSTINGS)).alias("parts"))
    placed = strata.join(F.broadcast(parts), "m").withColumn("part", F.pmod(F.xxhash64("row"), F.greatest("parts", F.lit(1))))
    return placed.where(F.size("terms") > 0).drop("row", "parts").groupBy("m", "part").applyInPandas(_block, INDEX)


class Items:
    """Items as sparse rows of term weights, in groups that share a bounded set of terms."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        self.groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # item numbers, terms, items x terms weights
        members: list[int] = []
        known: set[int] = set()
        for n, own in enumerate(terms):
            if members and len(known | set(own.tolist())) > TERMS_AT_ONCE:
                self._close(members, known, terms, weights)
                members, known = [], set()
            members.append(n)
            known |= set(own.tolist())
        if members:
            self._close(members, known, terms, weights)

    def _close(self, members: list[int], known: set[int], terms: list[np.ndarray], weights: np.ndarray) -> None:
        vocabulary = np.array(sorted(known), np.int32)
        matrix = np.zeros((len(members), len(vocabulary)), np.uint16)  # 1000 ln(2 N + 2) stays far below 2^16
        for row, n in zip(matrix, members, strict=True):
            row[np.searchsorted(vocabulary, terms[n])] = weights[terms[n]]
        self.groups.append((np.array(members, np.int32), vocabulary, matrix))


class Block:
    """One block of a stratum; the impact of a term is computed once per distinct frequency."""

    def __init__(self, m: int, docs: np.ndarray, terms: np.ndarray, tfs: np.ndarray, places: np.ndarray):
        self.docs, self.terms, self.places = docs, terms, places
        levels, which = np.unique(tfs, return_inverse=True)
        levels = levels.astype(np.int64)
        self.impacts = ((1_000_000_000 * levels) // (1000 * levels + 20 * m)).astype(np.float64)[which]
        self.own = np.flatnonzero(np.diff(terms, prepend=-1))  # the first posting of a term has its largest frequency

    def bounds(self, vocabulary: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """The most that each item can score here."""
        at = np.searchsorted(vocabulary, self.terms[self.own])
        at[at == len(vocabulary)] = 0
        known = vocabulary[at] == self.terms[self.own]
        return matrix[:, at[known]].astype(np.float64) @ self.impacts[self.own][known]

    def scores(self, vocabulary: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """items x documents."""
        at = np.searchsorted(vocabulary, self.terms)
        at[at == len(vocabulary)] = 0
        known = vocabulary[at] == self.terms
        used, rows = np.unique(at[known], return_inverse=True)
        impacts = np.zeros((len(used), len(self.docs)))
        impacts[rows, self.places[known]] = self.impacts[known]
        return matrix[:, used].astype(np.float64) @ impacts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(m, part, block, further columns) of index rows."""
    for batch in batches:
        for i in range(batch.num_rows):
            m, part, *lists = (column[i] for column in batch.columns)
            docs, terms, tfs, places = (x.values.to_numpy(zero_copy_only=False) for x in lists[:4])
            yield m.as_py(), part.as_py(), Block(m.as_py(), docs, terms, tfs, places), [x.as_py() for x in lists[4:]]


class Best:
    """The k best documents of each item so far; equal scores by smaller id."""

    def __init__(self, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        self.hits: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def offer(self, item: int, docs: np.ndarray, scores: np.ndarray) -> None:
        fine = scores >= self.floors[item]
        docs, scores = docs[fine], scores[fine]
        if item in self.hits:
            docs, scores = np.concatenate([self.hits[item][0], docs]), np.concatenate([self.hits[item][1], scores])
        order = np.lexsort((docs, -scores))[: self.k]
        self.hits[item] = docs[order], scores[order]
        if len(order) == self.k:
            self.floors[item] = max(self.floors[item], scores[order[-1]])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for item, (docs, scores) in self.hits.items():
            items = np.full(len(docs), item, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(docs), pa.array(scores.astype(np.int64))], schema=HITS)


def _best_blocks(index: DataFrame, items: Items) -> DataFrame:
    """(m, part, items): for each item the blocks with the highest bounds, listed by block."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int, int]]] = {}
        for m, part, block, _ in _blocks(batches):
            for members, vocabulary, matrix in items.groups:
                for item, bound in zip(members.tolist(), block.bounds(vocabulary, matrix).tolist(), strict=True):
                    lot = best.setdefault(item, [])
                    if bound > 0 and (len(lot) < FIRST or bound > lot[-1][0]):
                        lot.append((bound, m, part))
                        lot.sort(reverse=True)
                        del lot[FIRST:]
        rows = [(item, m, part, bound) for item, lot in best.items() for bound, m, part in lot]
        yield pa.RecordBatch.from_pydict(dict(zip(BOUNDS.names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in BOUNDS.names}, schema=BOUNDS)

    found = index.mapInArrow(bounds, "item int, m long, part long, bound double")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "part")
    first = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= FIRST)
    return first.groupBy("m", "part").agg(F.collect_list("item").alias("items"))


def _visit(index: DataFrame, items: Items, k: int, floors: np.ndarray) -> DataFrame:
    """(item, doc_id, score): documents that may be among an item's k best, all that are at least ``floors`` among them.

    With a column ``items`` only these are scored in a block.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, floors)
        for _, _, block, listed in _blocks(batches):
            for members, vocabulary, matrix in items.groups:
                wanted = np.isin(members, listed[0]) if listed else np.ones(len(members), bool)
                wanted &= block.bounds(vocabulary, matrix) >= best.floors[members]
                if not wanted.any():
                    continue
                scores = block.scores(vocabulary, matrix[wanted])
                for item, row in zip(members[wanted].tolist(), scores, strict=True):
                    fine = row >= best.floors[item]
                    if fine.any():
                        best.offer(item, block.docs[fine], row[fine])
        yield from best.rows()

    return index.mapInArrow(search, "item int, doc_id long, score long")


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(docs: DataFrame, texts: list[str], k: int, doc_id: str, text: str) -> DataFrame:
    """(item, rank, doc_id, score) of the items with these texts, written out."""
    vocabulary: dict[bytes, int] = {}
    terms = [np.array(sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(x)}), np.int32) for x in texts]
    spark = docs.sparkSession
    with scratch(spark) as stored:
        forward = stored(forward_rows(docs, vocabulary, doc_id, text))
        about = forward.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        weights = np.zeros(len(vocabulary))
        for row in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one per term of the items
            weights[row["term"]] = math.floor(1000 * math.log((2 * about["documents"] + 2) / (2 * row["count"] + 1)))
        items = Items(terms, weights)
        index = stored(stratified_index(forward, about["documents"], max(1, about["length"])))
        floors = np.ones(len(texts))  # scores are whole and above zero
        listed = _best_blocks(index, items)
        first = _ranked(_visit(index.join(listed, ["m", "part"]).select(*index.columns, "items"), items, k, floors), k)
        for row in first.groupBy("item").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).collect():
            floors[row["item"]] = row["score"]
        return kept(_ranked(_visit(index, items, k, floors), k))


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the ``k`` documents of the highest scores above zero (all, if fewer).

    Equal scores go by ascending doc_id, null ids last. Each row with a term is a document of its own, also if ids or texts repeat;
    null and empty texts are none. Items equal in id and text are one; items that share an id only are ranked each on its
    own; a null item id stays null; an item without terms has no rows. The id 2^63 - 1 counts as null. Empty tables give no
    rows; other columns are not read.
    """
    wanted = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    wanted = wanted.where("text is not null").distinct()
    size = wanted.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    passes, found = max(1, -(-size // ITEM_BYTES)), []
    for number in range(passes):
        lot = sorted(tuple(r) for r in wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
                     .select(F.col("item_id").isNull(), "text", "item_id").collect())
        names = docs.sparkSession.createDataFrame([(n, row[2]) for n, row in enumerate(lot)], "item int, item_id long")
        hits = _search(docs, [row[1] for row in lot], k, doc_id, text)
        found.append(hits.join(F.broadcast(names), "item"))
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    named = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id")
    return whole.select("item_id", F.col("rank").cast("int").alias("rank"), named, "score")
