"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable, measured, row_bytes

BROADCAST_BYTES_CONF = "spark.tidemark.broadcastBytes"
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_BYTES_CONF, str(BROADCAST_BYTES)))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is below the limit: by what its write observed, else by one aggregate over it."""
    known = measured(df)
    if known is not None and known["bytes"] <= broadcast_limit(df):
        return True
    return (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= broadcast_limit(df)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    small: bool | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join ``facts`` to a much smaller ``lookup`` (inner, left, left_semi or left_anti).

    A lookup measured below the broadcast limit is broadcast, so facts do not move. Above it both
    sides shuffle on the key; the facts of a hot key are split by adaptive execution, which reads
    the lookup's one partition for each part.
    """
    if small is None:
        small = fits_broadcast(lookup)
    keys, right = list(on), lookup
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    equal = [
        F.col(k).eqNullSafe(F.col(f"_r_{k}")) if null_safe else F.col(k) == F.col(f"_r_{k}") for k in keys
    ]
    joined = facts.join(F.broadcast(right) if small else right, reduce(lambda a, b: a & b, equal), how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def not_in(facts: DataFrame, other: DataFrame, column: str, other_column: str | None = None) -> DataFrame:
    """Rows of ``facts`` for which SQL ``column NOT IN (other)`` is true.

    An empty ``other`` keeps every row; a NULL in it keeps none; otherwise NULL probes drop out.
    Spark's own null-aware anti join always broadcasts the subquery, whatever its size.
    """
    values = durable(
        other.select(F.col(other_column or column).alias(column)).distinct(), nulls=F.count_if(F.col(column).isNull())
    )
    about = measured(values)
    if about["rows"] == 0:
        return facts
    if about["nulls"]:
        return facts.where(F.lit(False))
    small = about["bytes"] <= broadcast_limit(facts)
    return lookup_join(facts.where(F.col(column).isNotNull()), values, [column], "left_anti", small=small)
