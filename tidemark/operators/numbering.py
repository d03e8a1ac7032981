"""Running numbers over a whole table without a single-task sort."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable, measured, row_bytes


#: Bytes of rows in memory that one sorting task gets.
PARTITION_BYTES = 256 * 1024 * 1024


def range_partitions(df: DataFrame, partition_bytes: int = PARTITION_BYTES) -> int:
    """The number of partitions to sort ``df`` in: as many as its size needs, the session's number at least."""
    known = measured(df)
    size = known["bytes"] if known else df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // partition_bytes))


def global_row_number(df: DataFrame, order_cols: list[str], start: int = 0, out: str = "query_id") -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in the order of ``order_cols``.

    Range partitioning puts the rows in order across tasks; each row's number is its place in its
    partition plus the sizes of the partitions before it. Rows that tie on every order column may
    swap numbers, so name enough columns to leave only exact copies tied.

    The input partition id is the last sort key: it splits a large group of copies over many
    tasks, and unlike a random salt it stays the same when a task is repeated. The ordered rows
    are written out once, because the range bounds come from a sample and must not move between
    counting and numbering. The input is read for its size, for the sample and for the sort: what is not stored already
    is held on the executors' disks meanwhile, so it is computed once.
    """
    kept = measured(df) or df.storageLevel.useDisk or df.storageLevel.useMemory
    held = None if kept else df.persist(StorageLevel.DISK_ONLY)
    try:
        placed = _placed(df, order_cols)
    finally:
        if held is not None:
            held.unpersist()
    # One row per partition, so this window is small whatever the table holds.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select(
        (F.col("_index") + F.col("_offset") + F.lit(start + 1)).cast("bigint").alias(out), *df.columns
    )


def _placed(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """The rows in order, written out, with their partition and their place in it."""
    spread = df.withColumn("_origin", F.spark_partition_id())
    keys = [*order_cols, "_origin"]
    # A given number keeps adaptive execution from merging partitions: copies compress so well that
    # many of them look small.
    parts = range_partitions(df)
    ordered = spread.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # monotonically_increasing_id is (partition << 33) + row index.
    return durable(
        ordered.select(
            *df.columns,
            F.spark_partition_id().alias("_part"),
            (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)).alias("_index"),
        )
    )
