"""Benchmark passages in texts, found by embedding edit distance into Hamming distance.

The embedding is a random walk (CGK): at step j it emits the word it stands on and moves on by a bit
that depends on j and that word. Equal stretches keep two walks together; after an edit they
part and soon meet again, so few edits change few emitted words. Bit sampling then turns nearness into equal
keys: a key is made of the words emitted at a few random steps, and independent repetitions (walk and
steps drawn anew) raise the chance that a passage shares a key with its item to the wanted recall.

Items fall into length classes, each with a window and a stride. Windows of a text start at multiples of
the stride, those of an item at each of its words that has a window behind it, so wherever a text holds a part
of an item, windows of both start at the same place; a longer item has more of them. Keys only
propose: the edit distance of the whole item, counted in words, decides. All walks of a batch of texts advance together in numpy.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rows

#: Steps that make a key.
SAMPLED = 4
#: By length class: words of a window, its stride, the fewest words of its items, and the repetitions. Simulated with
#: random edits of EDITS of the words, these find 0.95 of the items at the class's worst length and more of longer ones.
CLASSES = ((8, 1, 8, 12), (12, 4, 15, 16), (24, 8, 40, 12))
#: Words of the shortest items that are searched; below the first class they must occur word for word.
FEWEST_WORDS = 4
#: Share of an item's words that may be edited.
EDITS = 0.2
#: Words of the items that are broadcast at once; a longer benchmark takes several passes.
ITEM_WORDS = 1_000_000
#: Words of the texts that are walked at once.
WORDS_AT_ONCE = 200_000
SEPARATOR = 0
TABLE_BITS = 20

HITS = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()),
])
CHUNKS, LETTERS = re.compile(r"\S+"), re.compile(r"\w+")


class WordNumbers(dict):
    """A number above zero for each word: what stands between white space, in lower case, without its punctuation."""

    LIMIT = 1_000_000

    def __missing__(self, chunk: str) -> int:
        word = "".join(LETTERS.findall(chunk))
        self[chunk] = number = (zlib.crc32(word.encode()) | 1) if word else SEPARATOR
        return number

    def of(self, text: str) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        chunks = text.lower().split()
        numbers = np.fromiter(map(self.__getitem__, chunks), np.uint32, len(chunks))
        return numbers[numbers != SEPARATOR]

    def places(self, text: str) -> list[tuple[int, int]]:
        """Start and end of each word that ``of`` numbers, in characters."""
        return [m.span() for m in CHUNKS.finditer(text) if self[m[0].lower()] != SEPARATOR]


class Walk:
    """One repetition for one length class: the walk's bits, and the steps that make a key."""

    PER_MIX = 16

    def __init__(self, window: int, repetition: int):
        draw = np.random.default_rng((window, repetition))
        # a walk covers about a word in two steps, so these steps lie within the window
        self.sampled = np.sort(draw.choice(np.arange(1, round(1.7 * window)), SAMPLED, replace=False))
        self.mixes = draw.integers(1 << 31, size=8, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        self.salt = np.uint32(draw.integers(1 << 31))

    def keys(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The key of the walk from each start; ``words`` ends with as many separators as a walk has steps."""
        at, key, picked = starts.astype(np.int32), np.zeros(len(starts), np.uint32), 0
        for step in range(int(self.sampled[-1]) + 1):
            if step == self.sampled[picked]:
                key = (key ^ words[at]) * np.uint32(0x9E3779B1)
                key ^= key >> np.uint32(15)
                picked += 1
                if picked == SAMPLED:
                    return key
            if step % self.PER_MIX == 0:
                mixed = (words ^ self.salt) * self.mixes[step // self.PER_MIX]
            bits = mixed[at]
            bits >>= np.uint32(31 - step % self.PER_MIX)
            bits &= np.uint32(1)
            at += bits.view(np.int32)
        return key


def edit_distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """The fewest word edits that turn ``item`` into a part of ``region``, and that part's start and end."""
    width = len(region) + 1
    cost, origin = np.zeros(width, np.int64), np.arange(width)
    order = np.arange(width)
    for n, word in enumerate(item, 1):
        swap = cost[:-1] + (region != word)
        drop = cost + 1
        new, start = np.empty(width, np.int64), np.empty(width, np.int64)
        new[0], start[0] = n, 0
        better = swap <= drop[1:]
        new[1:] = np.where(better, swap, drop[1:])
        start[1:] = np.where(better, origin[:-1], origin[1:])
        # an inserted word costs one more than its left neighbour: a running minimum of cost - place
        lifted = new - order
        least = np.minimum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == least, order, 0))
        cost, origin = least + order, start[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), end


class BenchmarkIndex:
    """The windows of all items under their keys, per length class and repetition."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        self.classes = []
        for n, (window, stride, shortest, repetitions) in enumerate(CLASSES):
            longest = CLASSES[n + 1][2] - 1 if n + 1 < len(CLASSES) else math.inf
            own = [i for i, (_, words) in enumerate(items) if shortest <= len(words) <= longest]
            if own:
                walks = [Walk(window, r) for r in range(repetitions)]
                self.classes.append((stride, self._tables(walks, own, window, stride)))

    def _tables(self, walks: list[Walk], own: list[int], window: int, stride: int) -> list[tuple]:
        """Per walk, with the keys in order: (walk, present, keys, item, shift of the window in its item)."""
        padded, end = [], np.full(128, SEPARATOR, np.uint32)
        counts = np.array([max(stride, len(self.items[i][1]) - window + 1) for i in own])
        lengths = np.array([len(self.items[i][1]) + len(end) for i in own])
        for i in own:
            padded += [self.items[i][1], end]
        words = np.concatenate(padded)
        item = np.repeat(np.array(own, np.int32), counts)
        shift = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)
        starts = np.repeat(np.cumsum(lengths) - lengths, counts) + shift
        tables = []
        for walk in walks:
            keys = walk.keys(words, starts)
            order = np.argsort(keys, kind="stable")
            present = np.zeros(1 << TABLE_BITS, bool)
            present[keys >> np.uint32(32 - TABLE_BITS)] = True
            tables.append((walk, present, keys[order], item[order], shift[order]))
        return tables

    def candidates(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows (text, item, place in ``words`` where it would start), in order; ``words`` ends with 128 separators.

        The place may lie before the text, where the text holds only the rest of an item.
        """
        found = [np.empty((0, 3), np.int64)]
        for stride, tables in self.classes:
            starts, new = np.arange(0, len(words) - 128, stride), []
            for walk, present, keys, item, shift in tables:
                own = walk.keys(words, starts)
                likely = np.flatnonzero(present[own >> np.uint32(32 - TABLE_BITS)])
                low = np.searchsorted(keys, own[likely], "left")
                n = np.searchsorted(keys, own[likely], "right") - low
                k = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                start = np.repeat(starts[likely], n)
                text = np.minimum(np.searchsorted(bounds, start, "right") - 1, len(bounds) - 2)
                new.append(np.stack([text, item[k], start - shift[k]], axis=1))
            found.append(np.unique(np.concatenate(new), axis=0))
        return np.unique(np.concatenate(found), axis=0)

    def regions(self, words: np.ndarray, bounds: np.ndarray, share: float) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first place, last place): candidates of one item that lie as near as its edits can move them."""
        now: tuple[int, int, int, int] | None = None
        for number, item, place in self.candidates(words, bounds).tolist():
            if now and now[:2] == (number, item) and place - now[2] <= share * len(self.items[item][1]):
                now = (number, item, now[2], place)
                continue
            if now:
                yield now
            now = (number, item, place, place)
        if now:
            yield now

    def matches(self, words: np.ndarray, bounds: np.ndarray, share: float = EDITS) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, end word, edits) of the best place of each item in each text."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for number, item, least, greatest in self.regions(words, bounds, share):
            own = self.items[item][1]
            most = int(share * len(own))
            first, last = bounds[number], bounds[number + 1] - 1
            low, high = max(first, least - most), min(last, greatest + len(own) + most)
            if best.get((number, item), (most + 1,))[0] == 0 or high - low < len(own) - most:
                continue
            region = words[low:high]
            ordered = np.sort(region)
            if (ordered[np.minimum(np.searchsorted(ordered, own), len(ordered) - 1)] == own).sum() < len(own) - most:
                continue
            edits, start, end = edit_distance(own, region)
            if edits <= most and (edits, low + start - first) < best.get((number, item), (most + 1, 0, 0))[:2]:
                best[number, item] = (edits, int(low + start - first), int(low + end - first))
        for (number, item), (edits, start, end) in sorted(best.items()):
            yield number, self.items[item][0], start, end, edits


class ShortItems:
    """Items too short for a window, as exact sequences of words: a table of keys per length, then the words themselves."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.lengths: dict[int, tuple[np.ndarray, list[tuple[int, np.ndarray]]]] = {}
        for n in sorted({len(words) for _, words in items}):
            own = sorted(((int(self.keys(words, n)[0]), id_, words) for id_, words in items if len(words) == n), key=lambda x: x[:2])
            self.lengths[n] = np.array([key for key, _, _ in own], np.uint64), [(id_, words) for _, id_, words in own]

    @staticmethod
    def keys(words: np.ndarray, n: int) -> np.ndarray:
        """A key of the n words from each place on."""
        key = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for i in range(n):
            key = (key ^ words[i : i + len(key)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key

    def matches(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, end word, 0) of the first place of each item in each text."""
        for n, (known, items) in self.lengths.items():
            keys, seen = self.keys(words, n), set()
            low = np.searchsorted(known, keys)
            for start in np.flatnonzero(known[np.minimum(low, len(known) - 1)] == keys).tolist():
                number = int(np.searchsorted(bounds, start, "right")) - 1
                for id_, own in items[low[start] : np.searchsorted(known, keys[start], "right")]:
                    if (number, id_) not in seen and np.array_equal(words[start : start + n], own):
                        seen.add((number, id_))
                        first = start - int(bounds[number])
                        yield number, id_, first, first + n, 0


def _scan(docs: DataFrame, items: list[tuple[int, str]], share: float) -> DataFrame:
    numbers = WordNumbers()
    known = [(id_, numbers.of(text or "")) for id_, text in items]
    shared = docs.sparkSession.sparkContext.broadcast([(id_, words) for id_, words in known if len(words) >= FEWEST_WORDS])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = BenchmarkIndex([i for i in shared.value if len(i[1]) >= CLASSES[0][0]])
        short = ShortItems([i for i in shared.value if len(i[1]) < CLASSES[0][0]])
        of, out = WordNumbers(), Rows(HITS)
        ids: list[int] = []
        texts: list[str] = []
        parts: list[np.ndarray] = []
        size, end = 0, np.full(1, SEPARATOR, np.uint32)

        def flushed() -> None:
            bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
            words = np.concatenate([*(x for p in parts for x in (p, end)), np.full(128, SEPARATOR, np.uint32)])
            spots, whose = [], None
            for number, item, first, last, edits in chain(index.matches(words, bounds, share), short.matches(words, bounds)):
                if number != whose:
                    spots, whose = of.places(texts[number]), number
                out.add(ids[number], item, spots[first][0], spots[last - 1][1] if last > first else spots[first][0], edits)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for id_, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    words = of.of(text or "")
                    ids.append(id_)
                    texts.append(text or "")
                    parts.append(words)
                    size += len(words)
                    if size > WORDS_AT_ONCE:
                        flushed()
                        ids, texts, parts, size = [], [], [], 0
                        yield out.take()
        if parts:
            flushed()
        yield out.take()

    return docs.mapInArrow(scan, "doc_id long, item_id long, start long, end long, edits int")


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", share: float = EDITS,
) -> DataFrame:
    """(doc_id, item_id, start, end, edits): for each document row and item, the best passage within the edits allowed.

    Words are compared in lower case without punctuation; up to ``share`` of an item's words may be
    inserted, dropped or exchanged. start and end are characters of the text. Null or empty texts
    hold nothing. Items of four to seven words are found as exact sequences of their words; items of fewer words (nulls too) are
    too common to be told from ordinary text and are not searched. Of equally good places the first counts. Rows that repeat an id
    are searched on their own; a null id stays null. Items without an id are not searched. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    items = items.where("text is not null").distinct()
    n_words = items.agg(F.sum(F.size(F.split("text", r"\s+")).cast("long"))).first()[0] or 0
    passes = max(1, -(-n_words // ITEM_WORDS))
    found = None
    for number in range(passes):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
        part = _scan(rows, sorted((r.item_id, r.text) for r in block.where("item_id is not null").toLocalIterator()), share)
        found = part if found is None else found.unionByName(part)
    return found
