"""The registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import oracle
from tidemark.llm.chat import format_preferences, stale_answer_pairs
from tidemark.llm.common import table
from tidemark.llm.decontamination import benchmark_matches
from tidemark.llm.language import fit_languages, predict_languages
from tidemark.llm.lexical import ranked_search
from tidemark.llm.packing import pack
from tidemark.llm.periodic import periodic_runs, run_digests
from tidemark.llm.pii import personal_data
from tidemark.llm.pivots import near_vectors
from tidemark.llm.quality import fit_quality, score_quality
from tidemark.llm.simhash import simhash_components
from tidemark.llm.topk import top_k
from tidemark.llm.urls import judge_urls, listed_urls
from tidemark.llm.token_counts import token_counts


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, listed_urls(pages)).drop("listed")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict_languages(docs, fit_languages(docs)).drop("languages", "shares")


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_preferences(stale_answer_pairs(table(spark, sf_dir, "conversations")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten, chosen by its id, repeat a stretch up to their end; a null id chooses nothing."""
    number = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if number % 10 or not words:
        return words
    n, g = len(words), number // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(table(spark, sf_dir, "documents"), prepare=repeated_tail))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OPERATORS = (
    op1_simhash, op2_urls, op3_pii, op4_token_counts, op5_packing, op6_language, op7_preferences, op8_decontamination,
    op9_top_k, op10_quality, op11_lexical, op12_periodic_runs, op13_near_vectors,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_urls": oracle.OP2, "op7_preferences": oracle.OP7, "op9_top_k": oracle.OP9, "op11_lexical": oracle.OP11,
        "op13_near_vectors": oracle.OP13,
    }
