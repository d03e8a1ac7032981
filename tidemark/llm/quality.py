"""Text quality by a small byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over overlapping chunks that together cover the whole
text, each filter's largest response in a chunk is kept, and the mean over the chunks gives one
probability. The network is fitted on the driver from a bounded sample of labelled rows, of which
each task cuts a bounded number of chunks; scoring runs where the texts are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rows, crc_fold, rows_of

#: Labelled rows that a network learns from at most, and chunks of each.
SAMPLE, SAMPLE_CHUNKS = 3000, 4
#: Numbers per byte, bytes of a filter, its step, and filters.
EMBEDDING, WIDTH, STRIDE, FILTERS = 6, 8, 2, 16
#: Bytes of a chunk; neighbours overlap so that every window of the text lies in one.
CHUNK = 1024
STEP = CHUNK - WIDTH + STRIDE
#: Chunks that are scored at once.
AT_ONCE = 64
#: Batches of a fit whatever the size of the sample, texts of a batch, and the optimiser's rates.
BATCHES, BATCH, RATE, DECAY = 1000, 32, 0.01, 1e-4

SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
SAMPLES = pa.schema([("order", pa.int64()), ("quality", pa.int32()), ("chunks", pa.binary())])


def chunks_of(data: bytes, first: int = 0, most: int | None = None) -> np.ndarray:
    """Chunks first, first + 1, .. of a text as rows of bytes; the last is filled up with zeros."""
    n = max(1, -(-(len(data) - CHUNK) // STEP) + 1) - first
    n = n if most is None else min(n, most)
    part = data[first * STEP : first * STEP + (n - 1) * STEP + CHUNK]
    flat = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    flat[: len(part)] = np.frombuffer(part, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::STEP]


def n_chunks(data: bytes) -> int:
    return max(1, -(-(len(data) - CHUNK) // STEP) + 1)


@dataclass
class ByteNetwork:
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: np.ndarray  # WIDTH * EMBEDDING x FILTERS
    bias: np.ndarray  # FILTERS
    weights: np.ndarray  # FILTERS
    offset: np.ndarray  # 1

    @classmethod
    def untrained(cls, seed: int = 7) -> ByteNetwork:
        draw = np.random.default_rng(seed)
        scale = (WIDTH * EMBEDDING) ** -0.5
        return cls(
            draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
            draw.normal(0, scale, (WIDTH * EMBEDDING, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float32), np.zeros(1, np.float32),
        )

    def values(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.weights, self.offset]

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """chunk x window x (WIDTH * EMBEDDING) numbers."""
        flat = self.embedding[chunks].reshape(len(chunks), -1)
        view = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * EMBEDDING, axis=1)
        return np.ascontiguousarray(view[:, :: STRIDE * EMBEDDING])

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Each filter's largest response in each chunk, at least zero."""
        windows = self.windows(chunks)
        responses = windows.reshape(-1, windows.shape[2]) @ self.filters
        return np.maximum(responses.reshape(len(chunks), -1, FILTERS).max(axis=1) + self.bias, 0)

    def score(self, text: str | None) -> float:
        """The probability that a text is good, from all its chunks."""
        data, total = (text or "").encode(), np.zeros(FILTERS)
        n = n_chunks(data)
        for first in range(0, n, AT_ONCE):
            total += self.pooled(chunks_of(data, first, AT_ONCE)).sum(axis=0)
        return float(1 / (1 + np.exp(-np.clip(total / n @ self.weights + self.offset[0], -30, 30))))

    def gradients(self, texts: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss over a batch of texts, each given by its chunks."""
        chunks, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), sizes)
        windows = self.windows(chunks)
        responses = (windows.reshape(-1, windows.shape[2]) @ self.filters).reshape(len(chunks), -1, FILTERS)
        where = responses.argmax(axis=1)
        largest = np.take_along_axis(responses, where[:, None], axis=1)[:, 0] + self.bias
        pooled = np.maximum(largest, 0)
        means = np.zeros((len(texts), FILTERS), np.float32)
        np.add.at(means, owner, pooled / sizes[owner, None])
        chance = 1 / (1 + np.exp(-np.clip(means @ self.weights + self.offset, -30, 30)))
        error = ((chance - labels) / len(texts)).astype(np.float32)
        back = (error / sizes)[owner, None] * self.weights * (largest > 0)
        chosen = windows[np.arange(len(chunks))[:, None], where]  # chunk x filter x inputs
        to_filters = np.einsum("cfi,cf->if", chosen, back)
        to_windows = back[:, :, None] * self.filters.T
        places = where[:, :, None] * STRIDE + np.arange(WIDTH)
        used = chunks[np.arange(len(chunks))[:, None, None], places]
        to_embedding = np.zeros_like(self.embedding)
        np.add.at(to_embedding, used, to_windows.reshape(*used.shape, EMBEDDING))
        return [to_embedding, to_filters, back.sum(axis=0), means.T @ error, error.sum(keepdims=True)]

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> None:
        """Adam over shuffled batches, always in the same order for the same sample."""
        draw = np.random.default_rng(seed)
        values = self.values()
        self.weights[:] = draw.normal(0, 0.3, FILTERS)
        first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        while step < BATCHES:
            order = draw.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                batch = order[at : at + BATCH]
                step += 1
                rate = RATE * max(0.02, 1 - step / BATCHES)
                for v, g, m, s in zip(values, self.gradients([texts[i] for i in batch], labels[batch]), first, second, strict=True):
                    g = g + DECAY * v
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)


def fit_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = 3, held_out: int = 1, sample: int = SAMPLE,
) -> ByteNetwork:
    """Fit a network on at most ``sample`` labelled rows outside the held-out fold.

    The rows are those with the smallest hash of their id. Of each text, chunks at places that the id
    picks are used. Null labels, ids and texts without a match teach nothing; without any labelled
    row the network gives 0.5 to all.
    """
    hashed = F.xxhash64("doc_id", F.lit("sample"))
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("quality"))
    known = known.where("quality is not null and doc_id is not null").where(crc_fold("doc_id", folds) != held_out)
    chosen = known.orderBy(hashed, "quality").limit(sample)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(SAMPLES, 200)
        for order, id_, quality, text_ in rows_of(batches):
            data = (text_ or "").encode()
            n = n_chunks(data)
            places = np.random.default_rng(zlib.crc32(str(id_).encode())).permutation(n)[:SAMPLE_CHUNKS]
            part = np.concatenate([chunks_of(data, int(p), 1) for p in sorted(places)])
            out.add(order, int(quality > 0), part.tobytes())
            if out.full():
                yield out.take()
        yield out.take()

    rows = texts.join(F.broadcast(chosen), "doc_id").select(hashed.alias("order"), "doc_id", "quality", "text")
    # rows that repeat an id in the documents would pass the bound, so it is set again
    found = rows.mapInArrow(cut, "order long, quality int, chunks binary").orderBy("order", "quality", "chunks").limit(sample)
    found = found.toPandas()
    network = ByteNetwork.untrained()
    if len(found):
        parts = [np.frombuffer(c, np.uint8).reshape(-1, CHUNK) for c in found["chunks"]]
        network.fit(parts, found["quality"].to_numpy(np.float32))
    return network


def score_quality(
    docs: DataFrame, network: ByteNetwork, doc_id: str = "doc_id", text: str = "text", folds: int = 3, held_out: int = 1
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1) and predicted (1 from a score of 0.5 on).

    A null text is scored as the empty text. Rows that repeat an id each get a row; a null id stays null; an
    empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network.values())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network_, out = ByteNetwork(*shared.value), Rows(SCORES)
        for id_, held, text_ in rows_of(batches):
            score = network_.score(text_)
            out.add(id_, held, score, int(score >= 0.5))
            if out.full():
                yield out.take()
        yield out.take()

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (crc_fold(doc_id, folds) == held_out).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    )
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def passing(docs: DataFrame, network: ByteNetwork, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``least``; a null text is scored as the empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(network.values())
    place = docs.columns.index(text)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network_ = ByteNetwork(*shared.value)
        for batch in batches:
            good = [network_.score(text_) >= least for (text_,) in rows_of([batch.select([place])])]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(passed, docs.schema)
