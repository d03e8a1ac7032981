"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors become integers, their components the weights of terms. Document ranges form blocks: a
forward index (ids and weights) with each term's largest and smallest weight. A query's bound for a
block is the sum over its terms of the largest product possible; blocks are scored in the order of
their bounds, through their forward index, until the next bound falls below the k-th score.

Blocks of one slice and queries of one batch meet in one task, so neither side is ever whole in a
task; the k best of each slice are merged per query. Rows are numbered in their stored order, and a slice and a
batch hold a fixed number of successive rows, whatever the size of the table and its ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept

#: Rows of a block, blocks of a slice, and queries of a batch.
BLOCK, SLICE, BATCH = 256, 64, 1024
#: Products and sums below this are exact in double precision.
EXACT = 2**53

HITS = "query_row long, query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, weights): floor(scale * x); vectors that are null or not finite drop out."""
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(
        F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)
    )
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    return rows.where(fine).select("vec_id", F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("weights"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows``, written out, with ``row``: their numbers from 0 in the order of the partitions. One offset per partition is broadcast."""
    part = F.spark_partition_id()
    placed = rows.withColumns({"_part": part, "_index": F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)})
    placed = kept(placed)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    found = placed.join(F.broadcast(offsets), "_part")
    return found.withColumn("row", F.col("_index") + F.col("_offset")).drop("_part", "_index", "_offset")


def _matrix(weights: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(weights), width))
    for row, values in zip(out, weights, strict=True):
        row[: len(values)] = values
    return out


def search_slice(docs: pd.DataFrame, queries: pd.DataFrame, k: int, block: int = BLOCK) -> pd.DataFrame:
    """The k best of ``docs`` (row, vec_id, weights) for each of ``queries`` (query_row, query_id, weights), their own row left out."""
    if docs.empty or queries.empty:
        return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")
    width = max(docs["weights"].map(len).max(), queries["weights"].map(len).max(), 1)
    docs = docs.sort_values(["vec_id", "row"])
    own, ids, d, q = docs["row"].to_numpy(), docs["vec_id"].to_numpy(), _matrix(docs["weights"], width), _matrix(queries["weights"], width)
    if width * float(np.abs(d).max(initial=0)) * float(np.abs(q).max(initial=0)) >= EXACT:
        d, q = d.astype(object), q.astype(object)
        for m, weights in ((d, docs["weights"]), (q, queries["weights"])):
            for row, values in zip(m, weights, strict=True):
                row[: len(values)] = [int(v) for v in values]
                row[len(values) :] = 0
    starts = range(0, len(ids), block)
    top = np.array([d[s : s + block].max(axis=0) for s in starts])
    low = np.array([d[s : s + block].min(axis=0) for s in starts])
    zero = q * 0
    bounds = np.maximum(q, zero) @ top.T + np.minimum(q, zero) @ low.T
    found = []
    for row, query_id, vector, bound in zip(queries["query_row"].to_numpy(), queries["query_id"].to_numpy(), q, bounds, strict=True):
        best_ids, best = np.empty(0, np.int64), np.empty(0, d.dtype)
        for b in np.argsort(-bound, kind="stable"):
            if len(best) == k and bound[b] < best[-1]:
                break
            rows = slice(b * block, (b + 1) * block)
            other = own[rows] != row
            best_ids = np.concatenate([best_ids, ids[rows][other]])
            best = np.concatenate([best, (d[rows] @ vector)[other]])
            order = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[order], best[order]
        found.append(pd.DataFrame({"query_row": row, "query_id": query_id, "vec_id": best_ids, "score": [_long(s) for s in best]}))
    return pd.concat(found).astype("int64")


def _long(score) -> int:
    return max(-(2**63), min(2**63 - 1, int(score)))


def top_k(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5, scale: int = 256, every: int = 50
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for each row whose id ``every`` divides.

    Ties go to the smaller id; fewer than k candidates are all returned. Vectors that are null, or hold null
    or non-finite components, and rows without an id take no part. A shorter vector counts as
    filled up with zeros. Rows, not ids, are told apart: of rows that repeat an id each asks, and is a candidate of the others; each has
    ranks of its own. A score beyond a long is set to the nearest long. An empty table
    gives no rows; other columns are not read.
    """
    docs = numbered(quantised(vectors, vec_id, embedding, scale))
    asked = docs.where(F.col("vec_id") % every == 0)
    n_docs, n_queries = docs.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    n_slices, n_batches = -(-n_docs // (BLOCK * SLICE)) or 1, -(-n_queries // BATCH) or 1
    sliced = docs.withColumn("slice", F.floor(F.col("row") / (BLOCK * SLICE)))
    sliced = sliced.withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_batches - 1).cast("long"))))
    batches = asked.select(
        F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("weights").alias("weights"),
        F.pmod(F.xxhash64("row"), F.lit(n_batches).cast("long")).alias("batch"),
    )
    batches = batches.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slices - 1).cast("long"))))

    def search(docs_: pd.DataFrame, queries_: pd.DataFrame) -> pd.DataFrame:
        return search_slice(docs_, queries_, k)

    hits = (
        sliced.groupBy("slice", "batch").cogroup(batches.groupBy("slice", "batch")).applyInPandas(search, HITS)
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
