"""Periodic runs in texts by internal pattern matching.

A run is a stretch of words that repeats with its smallest period q at least three times, and that no neighbouring
word extends. Where q lies between b and 2b, b a power of two, the run holds a dyadic block (b words from a multiple
of b on) together with its copy q words further. So for each block the occurrences in the neighbouring window
are queried: blocks of b words are a range of the suffix array, and a wavelet tree over that array gives a range's
smallest value above a bound (range successor). Occurrences within b words of each other are a progression. Up to two are
candidate periods themselves; three or more tell that the block itself is periodic, with the progression's difference p, and
then the run's period is the distance between the ends, or the starts, of the two p-periodic stretches.
Each candidate is extended both ways with the ranks of all stretches of 2^k words, which makes it exact.

Many texts are put end to end, each closed by a word of its own, so that all steps are numpy over a
hundred thousand words at once; a longer text is taken whole, at about 250 bytes of memory a word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rows, rows_of

#: The shortest run in words, and how often its period fits at least. The windows below need at least these.
LEAST, REPEATS = 24, 3
#: Logarithm of the shortest block: a run of LEAST words holds a block of 8 and its copy up to 8 words further.
FIRST_LEVEL = 3
WORDS_AT_ONCE = 100_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])

#: Takes a document's id and its words, and gives the words to search.
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def sorted_stretches(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and for k = 0, 1, .. the rank of the 2^k words from each place on.

    A rank is the first place in the suffix array among equal stretches. Each step sorts only what is still tied;
    the last ranks are all different. The last word must occur once.
    """
    order = np.argsort(words, kind="stable").astype(np.int32)
    first = np.flatnonzero(np.diff(words[order], prepend=words[order[0]] - 1))
    rank = np.empty(len(words), np.int32)
    rank[order] = np.repeat(first, np.diff(first, append=len(words)))
    ranks, width = [rank], 1
    while True:
        sizes = np.bincount(rank, minlength=len(words))
        slots = np.flatnonzero(sizes[rank[order]] > 1)
        if not len(slots):
            return order, ranks
        tied = order[slots]
        key = rank[tied].astype(np.int64) * len(words) + rank[tied + width]
        sort = np.argsort(key, kind="stable")
        tied, key = tied[sort], key[sort]
        order[slots] = tied
        first = np.flatnonzero(np.diff(key, prepend=-1))
        rank = rank.copy()
        rank[tied] = np.repeat(slots[first], np.diff(first, append=len(key)))
        ranks.append(rank)
        width *= 2


class WaveletTree:
    """Counts and order statistics over ranges of an array of numbers below its length, many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for bit in reversed(range(max(1, int(len(values) - 1).bit_length()))):
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the values at low, .., high - 1 are below ``bound`` (at most the array's length)."""
        full = bound >= len(self.levels[0][1]) - 1
        found, width = np.zeros(len(low), np.int64), high - low
        for bit, zeros in self.levels:
            before, upto = zeros[low], zeros[high]
            one = (bound >> bit & 1).astype(bool)
            found += np.where(one, upto - before, 0)
            low = np.where(one, zeros[-1] + low - before, before)
            high = np.where(one, zeros[-1] + high - upto, upto)
        return np.where(full, width, found)

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest, counted from 0, of the values at low, .., high - 1."""
        found = np.zeros(len(low), np.int64)
        for bit, zeros in self.levels:
            before, upto = zeros[low], zeros[high]
            one = nth >= upto - before
            found |= one.astype(np.int64) << bit
            nth = np.where(one, nth - (upto - before), nth)
            low = np.where(one, zeros[-1] + low - before, before)
            high = np.where(one, zeros[-1] + high - upto, upto)
        return found


def _ahead(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from a and from b on are equal."""
    at = np.zeros(len(a), np.int64)
    for k in reversed(range(len(ranks))):
        at += (ranks[k][a + at] == ranks[k][b + at]).astype(np.int64) << k
    return at


def _back(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before a and before b are equal; a < b."""
    at = np.zeros(len(a), np.int64)
    for k in reversed(range(len(ranks))):
        low = a - at - (1 << k)
        equal = (low >= 0) & (ranks[k][np.maximum(low, 0)] == ranks[k][np.maximum(b - at - (1 << k), 0)])
        at += equal.astype(np.int64) << k
    return at


def _candidates(order: np.ndarray, ranks: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) that every run is among."""
    tree = None
    for level in range(FIRST_LEVEL, len(ranks)):
        size = 1 << level
        blocks = np.arange(0, len(order), size)
        low = ranks[level][blocks]
        sizes = np.bincount(ranks[level], minlength=len(order))[low]
        blocks, low, sizes = (x[sizes > 1].astype(np.int64) for x in (blocks, low, sizes))
        if not len(blocks):
            continue
        tree = tree or WaveletTree(order)
        high = low + sizes
        windows = [(size, 2 * size)] if level > FIRST_LEVEL else [(1, size + 1), (size + 1, 2 * size)]
        for nearest, end in windows:
            passed = tree.below(low, high, np.minimum(blocks + nearest, len(order)))
            n = tree.below(low, high, np.minimum(blocks + end, len(order))) - passed
            some = n > 0
            x, a, b, k, n = (v[some] for v in (blocks, low, high, passed, n))
            if not len(x):
                continue
            first = tree.smallest(a, b, k)
            yield x, first - x
            if nearest == 1:
                continue  # within the block's length the nearest copy tells the period
            two = n > 1
            x, first, n, second = x[two], first[two], n[two], tree.smallest(a[two], b[two], k[two] + 1)
            yield x[n == 2], (second - x)[n == 2]
            many = n > 2
            x, y, p = x[many], first[many], (second - first)[many]
            yield x, y + _ahead(ranks, y, y + p) - x - _ahead(ranks, x, x + p)
            yield x, y - _back(ranks, y, y + p) - x + _back(ranks, x, x + p)


def maximal_runs(words: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Rows (start, end, smallest period) of all runs, by start, then period; the last word must occur once."""
    if least < LEAST or repeats < REPEATS:
        raise ValueError(f"runs of fewer than {LEAST} words or {REPEATS} periods are not searched")
    order, ranks = sorted_stretches(words)
    found = [np.empty((0, 3), np.int64)]
    for x, period in _candidates(order, ranks):
        x, period = np.unique(np.stack([x, period]), axis=1)
        there = (period > 0) & (x + period < len(order))  # progressions may tell periods beyond the end, where nothing is
        x, period = x[there], period[there]
        start, end = x - _back(ranks, x, x + period), x + period + _ahead(ranks, x, x + period)
        long = end - start >= np.maximum(least, repeats * period)
        found.append(np.unique(np.stack([start, end, period], axis=1)[long], axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    # of equal stretches the smallest period counts; np.unique has sorted by start, end and period
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that any run holds after its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, repeats: int = REPEATS, prepare: Prepare | None = None
) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (start, length, period; by start, then period) and collapsed.

    Words stand between ASCII white space and are numbered from 0. ``collapsed`` is the text without the words that any run
    holds after its first period, joined by single spaces. A null text has no words, no runs and an empty collapsed
    text. ``prepare`` may exchange a document's words beforehand. Rows that repeat an id each get a row; a null id stays null;
    an empty table gives no rows. Other columns are not read.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(RUNS)
        ids: list[int | None] = []
        texts: list[list[bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            numbers = defaultdict(count(len(texts)).__next__)  # below are the closing words
            ends = np.cumsum([len(t) + 1 for t in texts])
            flat = np.empty(ends[-1], np.int64)
            for n, (words, end) in enumerate(zip(texts, ends, strict=True)):
                flat[end - 1 - len(words) : end - 1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                flat[end - 1] = n
            found = maximal_runs(flat, least, repeats)
            whose = np.searchsorted(ends, found[:, 0], side="right")
            of: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
            for n, (start, end, period) in zip(whose.tolist(), found.tolist(), strict=True):
                of[n].append((start - int(ends[n]) + 1 + len(texts[n]), end - start, period))
            for n, (id_, words) in enumerate(zip(ids, texts, strict=True)):
                runs = of.get(n, [])
                out.add(id_, len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], _collapsed(words, runs))
            return out.take()

        for id_, text_ in rows_of(batches):
            words = (text_ or "").encode().split()
            ids.append(id_)
            texts.append(prepare(id_, words) if prepare else words)
            size += len(words) + 1
            if size >= WORDS_AT_ONCE:
                yield flush()
                ids, texts, size = [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(
        search, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


def run_digests(found: DataFrame) -> DataFrame:
    """``periodic_runs`` as digests: doc_id, n_runs, the run of the greatest exponent, and hashes of runs and collapsed text.

    The greatest exponent (length by period, exactly) counts; ties go to the smaller start, then period. Without a run
    start, length, period and exponent_milli are null.
    """
    better = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(better(b, r), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
