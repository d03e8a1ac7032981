"""Language identification as mixture inference.

Each language is a distribution over hashed character n-grams, learned from labelled texts. A
document is a mixture of languages: expectation maximisation estimates the proportions from its
n-grams' likelihoods, and the set of languages is the one of the largest likelihood less a penalty for every
language in it. So a text in two languages gets both, and one in a single language one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rows, crc_fold, rows_of

#: Hashed n-grams of one to three characters share so many buckets; the model's size depends on it and the languages.
BUCKETS = 1 << 16
#: Characters of a text that are hashed at once.
CHUNK = 1 << 20
SMOOTHING, STEPS, TINY = 0.5, 20, np.float32(1e-30)
#: Log-likelihood that another language must bring per language, times the logarithm of the n-grams.
PENALTY = 3.0
UNDETERMINED = "und"

PREDICTIONS = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
    ("languages", pa.list_(pa.string())), ("shares", pa.list_(pa.float64())),
])
COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


def _hashes(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, part by part; case is folded, what is no letter is a gap."""
    text = text.lower()
    for at in range(0, len(text), CHUNK):
        part = text[max(0, at - 2) : at + CHUNK]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
        # below the letters of Latin-1 only a to z are letters
        gap = (codes < 0xC0) & ((codes < 97) | (codes > 122)) & (codes != 0xAA) & (codes != 0xB5) & (codes != 0xBA)
        c = np.where(gap, np.uint32(32), codes)
        keep = 2 if at else 0
        grams = [c[keep:] * np.uint32(0x9E3779B1)]
        if len(c) > 1:
            two = c[:-1] * np.uint32(0x85EBCA77) + c[1:] * np.uint32(0xC2B2AE3D) + np.uint32(0x27D4EB2F)
            grams.append(two[max(keep - 1, 0) :])
        if len(c) > 2:
            three = c[:-2] * np.uint32(0x165667B1) + c[1:-1] * np.uint32(0x9E3779B1) + c[2:] * np.uint32(0x85EBCA77)
            grams.append(three)
        mixed = np.concatenate(grams)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        yield mixed >> np.uint32(16)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram buckets of a text and how often each occurs."""
    counts = np.zeros(BUCKETS, np.int64)
    for part in _hashes(text):
        counts += np.bincount(part, minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


@dataclass
class LanguageModel:
    languages: list[str]
    #: log of the probability of each bucket (row) in each language (column)
    log_likelihood: np.ndarray

    def mixture(self, text: str) -> tuple[list[str], list[float]]:
        """The languages of a text and their shares, the largest first."""
        buckets, n = ngrams(text)
        logs = self.log_likelihood[buckets]
        peaks = logs.max(axis=1)
        likelihood, n = np.exp(logs - peaks[:, None]), n.astype(np.float32)
        single = n @ (logs - peaks[:, None])
        chosen, shares = [int(np.argmax(single))], np.ones(1)
        best, price = float(single[chosen[0]]), PENALTY * math.log(max(2.0, float(n.sum())))
        # no set can bring more than all languages together do
        limit, of_all = self._fit(likelihood, n)
        rest = [int(i) for i in np.argsort(-of_all, kind="stable") if i != chosen[0]]
        while rest and limit - best > price:
            trial = [*chosen, rest.pop(0)]
            value, part = self._fit(likelihood[:, trial], n)
            if value - best <= price:
                break
            best, chosen, shares = value, trial, part
        order = sorted(range(len(chosen)), key=lambda i: (-shares[i], self.languages[chosen[i]]))
        return [self.languages[chosen[i]] for i in order], [float(shares[i]) for i in order]

    @staticmethod
    def _fit(likelihood: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
        """The log-likelihood of the best mixture and its shares, by expectation maximisation."""
        shares = np.full(likelihood.shape[1], 1 / likelihood.shape[1], np.float32)
        total = n.sum()
        for _ in range(STEPS):
            shares *= ((n / np.maximum(likelihood @ shares, TINY)) @ likelihood) / total
        return float(n @ np.log(np.maximum(likelihood @ shares, TINY))), shares / shares.sum()


def fit_languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, held_out: int = 0
) -> LanguageModel:
    """Counts the n-grams of every labelled text outside the held-out fold; only the model's table leaves Spark.

    Rows without a label or text teach nothing.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for lang_, text_ in rows_of(batches):
            if lang_ not in counts:
                counts[lang_] = np.zeros(BUCKETS, np.int64)
            for part in _hashes(text_):
                counts[lang_] += np.bincount(part, minlength=BUCKETS)
        out = Rows(COUNTS, BUCKETS)
        for lang_, n in counts.items():
            for bucket in np.flatnonzero(n):
                out.add(lang_, bucket, n[bucket])
            yield out.take()

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (crc_fold(doc_id, folds) != held_out))
    known = known.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = known.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    languages = sorted(found["lang"].unique())
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    column = {name: i for i, name in enumerate(languages)}
    table[found["bucket"].to_numpy(int), found["lang"].map(column).to_numpy(int)] += found["n"].to_numpy(float)
    return LanguageModel(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def predict_languages(
    docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text", folds: int = 5, held_out: int = 0
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, and all languages found with their shares.

    ``lang_pred`` is the language with the largest share and ``score`` that share; texts that are null or
    without a letter, and all texts if nothing was learned, are ``und`` with score 0. Of equal shares the first name
    wins. Rows that repeat an id each get a row; a null id stays null. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_likelihood))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_, out = LanguageModel(*shared.value), Rows(PREDICTIONS)
        for id_, held, text_ in rows_of(batches):
            if not text_ or not model_.languages or not any(map(str.isalpha, text_)):
                out.add(id_, held, UNDETERMINED, 0.0, [], [])
            else:
                names, shares = model_.mixture(text_)
                out.add(id_, held, names[0], min(1.0, shares[0]), names, shares)
            if out.full():
                yield out.take()
        yield out.take()

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (crc_fold(doc_id, folds) == held_out).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    )
    return rows.mapInArrow(
        predicted,
        "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>, shares array<double>",
    )
