"""Key checks, batch audits and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def require_unique(df: DataFrame, key: str, what: str) -> None:
    """Raise if ``key`` is NULL in some row or occurs more than once."""
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    about = rows.agg(F.count_if(F.col(key).isNull()).alias("nulls"), F.max("rows").alias("most")).first()
    if about["nulls"]:
        raise ValueError(f"{what}: {key} is NULL")
    if (about["most"] or 0) > 1:
        raise ValueError(f"{what}: {key} is not unique")


def load_audit(queries: DataFrame) -> DataFrame:
    """One row per load batch: time and id range, and row count."""
    return queries.groupBy("created_at").agg(
        F.min("starttime").alias("min_starttime"),
        F.max("starttime").alias("max_starttime"),
        F.min("query_id").alias("min_query_id"),
        F.max("query_id").alias("max_query_id"),
        F.count(F.lit(1)).alias("cnt"),
    )


def snapshot_audit(space: DataFrame) -> DataFrame:
    """One row per snapshot day: number of batches and rows."""
    return space.groupBy("snapshot_date").agg(
        F.count_distinct("created_at").alias("cnt_created_at"), F.count(F.lit(1)).alias("cnt")
    )


def preview(df: DataFrame, n: int = 100, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows; any ``n`` rows if no order is given."""
    return (df.orderBy(*order) if order else df).limit(n)
