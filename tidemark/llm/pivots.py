"""Near-duplicates of vectors by a pivot-permutation index.

A bounded sample gives the pivots, none too near another. Each vector is described by its nearest pivots in
their order; the description grows with the logarithm of the number of pivots, which keeps the recall alike.
A vector's first pivot is its home: a cell of the index holds the vectors at home there. To find its partners,
a vector visits the cells of the pivots that describe it. In a cell, inverted lists (pivot to residents) count
the pivots that a visitor shares with each resident; those that share enough are verified by the exact cosine.
Every vector has one home, so a link is counted once from either side, and no pair leaves the task: a tile
gives numbers of links and a forest.

Equal vectors are one row with a weight beforehand. Cells are cut by hash into tiles of bounded size, so a cell
that holds a third of all rows is spread over many tasks; the number of pivots grows with the root of the
number of vectors, up to MOST_PIVOTS.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept
from tidemark.llm.components import connected_components

#: Pivots at least and at most, and vectors of the sample for each. The sample is all that the index is fitted on.
LEAST_PIVOTS, MOST_PIVOTS, SAMPLED = 16, 32_768, 2
#: Cosine that no two pivots reach.
SPREAD = 0.8
#: Pivots that describe a vector at least, and those that a candidate shares with it.
DESCRIBED, SHARED = 8, 3
#: Residents and visitors of a tile, and visitors that are compared at once.
TILE, AT_ONCE = 4096, 512

TILES = "node long, links long, root long"


def _matrix(vectors, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros, each scaled by a power of two so that its length is no overflow."""
    out = np.zeros((len(vectors), width))
    for row, values in zip(out, vectors, strict=True):
        row[: len(values)] = values
    exponents = np.frexp(np.abs(out).max(axis=1, initial=0))[1]
    return np.ldexp(out, -exponents[:, None])


def spread_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Unit vectors of the sample, in its order, of which no two reach a cosine of SPREAD."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen, n = np.empty((most, sample.shape[1])), 0
    for start in range(0, len(unit), 256):
        block = unit[start : start + 256]
        far = (block @ chosen[:n].T).max(axis=1, initial=-1) < SPREAD
        fresh = n
        for vector in block[far]:
            if n < most and (n == fresh or (chosen[fresh:n] @ vector).max() < SPREAD):
                chosen[n] = vector
                n += 1
    return chosen[:n]


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    near = vectors @ pivots.T
    described = min(max(DESCRIBED, len(pivots).bit_length()), len(pivots))
    some = np.argpartition(-near, described - 1, axis=1)[:, :described]
    values = np.take_along_axis(near, some, axis=1)
    return np.take_along_axis(some, np.lexsort((some, -values), axis=1), axis=1).astype(np.int32)


def shared_pivots(visitors: np.ndarray, residents: np.ndarray) -> np.ndarray:
    """visitors x residents: how many pivots both descriptions hold, counted through the residents' inverted lists."""

    def lists(described: np.ndarray) -> dict[int, np.ndarray]:
        flat = described.ravel()
        order = np.argsort(flat, kind="stable")
        pivots, starts = np.unique(flat[order], return_index=True)
        return dict(zip(pivots.tolist(), np.split(order // described.shape[1], starts[1:]), strict=True))

    counts = np.zeros((len(visitors), len(residents)), np.uint8)
    inverted = lists(residents)
    for pivot, rows in lists(visitors).items():
        if pivot in inverted:
            counts[np.ix_(rows, inverted[pivot])] += 1
    return counts


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (each node's root, a smaller or equal node) with the edges a, b added."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low < high
        if not apart.any():
            return label
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]


def compare_tile(residents: pd.DataFrame, visitors: pd.DataFrame, width: int, threshold: float, shared: int = SHARED) -> pd.DataFrame:
    """(node, links, root): each visitor's number of linked residents by weight, and each tied node's root within the tile."""
    if residents.empty or visitors.empty:
        return pd.DataFrame({"node": [], "links": [], "root": []}, dtype="Int64")
    r, own, weight = _matrix(residents["vector"], width), residents["node"].to_numpy(), residents["copies"].to_numpy()
    r_length, r_pivots = np.linalg.norm(r, axis=1), np.stack(residents["pivots"].to_list())
    nodes, places = np.unique(np.concatenate([own, visitors["node"].to_numpy()]), return_inverse=True)
    label, links = np.arange(len(nodes)), []
    for start in range(0, len(visitors), AT_ONCE):
        part = visitors.iloc[start : start + AT_ONCE]
        v = _matrix(part["vector"], width)
        candidates = shared_pivots(np.stack(part["pivots"].to_list()), r_pivots) >= min(shared, r_pivots.shape[1])
        cosine = (v @ r.T) / (np.linalg.norm(v, axis=1)[:, None] * r_length[None, :])
        linked = candidates & (cosine >= threshold) & (part["node"].to_numpy()[:, None] != own[None, :])
        links.append(linked @ weight)
        a, b = np.nonzero(linked)
        label = _joined(label, places[len(own) + start + a], places[b])
    counts = np.concatenate(links)
    some = counts > 0
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    found = pd.DataFrame({"node": visitors["node"].to_numpy()[some], "links": counts[some], "root": pd.NA})
    forest = pd.DataFrame({"node": nodes[tied], "links": pd.NA, "root": nodes[label[tied]]})
    return pd.concat([found, forest]).astype("Int64")


def described(vectors: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """``vectors`` (node, copies, vector) with ``pivots``, the nearest in their order."""
    kind = vectors.schema["vector"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                near = nearest_pivots(_matrix(part.column("vector").to_pylist(), width), shared.value)
                yield part.append_column("pivots", pa.array(list(near), pa.list_(pa.int32())))

    return vectors.mapInArrow(describe, f"node long, copies long, vector {kind}, pivots array<int>")


def _tiles(index: DataFrame, width: int, threshold: float) -> DataFrame:
    """Compare the visitors of every cell with its residents: (node, links, root)."""
    # columns of their own, so that both sides of the table can meet
    residents = index.select(F.get("pivots", F.lit(0)).alias("cell"), *[F.col(c).alias(c) for c in index.columns])
    visitors = index.withColumn("cell", F.explode("pivots"))
    # one row per pivot
    at_home = residents.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("home_parts"))
    calls = visitors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("visit_parts"))
    parts = F.broadcast(kept(at_home.join(calls, "cell")))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        rows = rows.join(parts, "cell").withColumn(own, F.pmod(F.xxhash64("node"), F.col(f"{own}_parts")))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1))).drop("home_parts", "visit_parts")

    keys = ["cell", "home", "visit"]

    def compare(residents_: pd.DataFrame, visitors_: pd.DataFrame) -> pd.DataFrame:
        return compare_tile(residents_, visitors_, width, threshold)

    return dealt(residents, "home", "visit").groupBy(*keys).cogroup(dealt(visitors, "visit", "home").groupBy(*keys)).applyInPandas(compare, TILES)


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id and kept.

    Rows link when the cosine of their vectors, in double precision, is at least ``threshold`` (which only verified
    pairs do; the index may miss some). ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    vec_id reachable, itself included, and ``kept`` tells whether it is the row's own. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. A shorter vector counts as filled up with zeros. Rows that repeat an id are rows
    of their own; a null id names no component unless all its members are null. An empty table gives no rows; other columns are
    not read.
    """
    # single precision stays so until it is compared, which halves what moves; adding zero leaves no negative zero
    number = "float" if vectors.select(F.col(embedding)).dtypes[0][1] == "array<float>" else "double"
    x = F.transform(F.col(embedding).cast(f"array<{number}>"), lambda v: v + F.lit(0).cast(number))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fine = F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    hashes = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), F.col("vector")).alias("h2")]
    rows = rows.withColumn("vector", F.when(fine, F.col("vector"))).select("vec_id", "vector", *hashes)
    equal = rows.where("vector is not null").groupBy("h1", "h2")
    equal = equal.agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    equal = kept(equal.withColumn("node", F.monotonically_increasing_id()))
    n, width = equal.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()

    most = min(MOST_PIVOTS, max(LEAST_PIVOTS, 2 * math.isqrt(n)))
    sample = equal.orderBy(F.xxhash64("h1", "h2"), "h1", "h2").limit(SAMPLED * most).select("vector").collect()
    pivots = spread_pivots(_matrix([r["vector"] for r in sample], width), most) if sample else np.ones((1, width))
    index = kept(described(equal.select("node", "copies", "vector"), pivots, width))
    found = kept(_tiles(index, width, threshold))

    links = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found.where("root is not null").select(F.col("node").alias("u"), F.col("root").alias("v")))
    nodes = equal.drop("vector").join(links, "node", "left").join(components, "node", "left")
    nodes = kept(nodes.withColumn("component", F.coalesce("component", "node")))
    smallest = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    n_links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    named = nodes.join(smallest, "component").select("h1", "h2", n_links, "component_id")
    linked = rows.where("vector is not null").select("vec_id", "h1", "h2").join(named, ["h1", "h2"]).drop("h1", "h2")
    alone = rows.where("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    whole = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return whole.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
