"""The corpus pipeline: drop poor documents, near copies and benchmark leaks, mask personal data, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.decontamination import benchmark_matches
from tidemark.llm.packing import pack
from tidemark.llm.pii import mask_personal_data
from tidemark.llm.quality import fit_quality, passing
from tidemark.llm.simhash import without_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of the documents given."""
    return passing(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one with the smallest id: SimHash of three words, two bits."""
    return without_near_copies(docs, words=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark passage; rows are told apart by id and text, so null and repeated ids do no harm."""
    row = F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")))
    named = docs.select(row.alias("row"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.coalesce("item_id", F.lit(-1)).alias("item_id"), "text")
    leaks = benchmark_matches(named, items, doc_id="row").select("doc_id").distinct()
    whole = docs.select(F.struct("*").alias("doc"), row.alias("row"))
    return whole.join(leaks, whole["row"] == leaks["doc_id"], "left_anti").select("doc.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the personal data in their texts replaced by the names of its kinds."""
    return mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The stages learn and pack, which SQL cannot express; tests compare each with brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what all stages keep of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
