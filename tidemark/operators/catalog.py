"""One table catalog out of the internal and the external one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import qualified
from tidemark.sources.contracts import TABLE_ATTRIBUTES
from tidemark.sources.fixed_values import (
    CLUSTER_LOCATION,
    EXTERNAL_ID,
    EXTERNAL_TABLE,
    INTERNAL_TABLE,
    SYSTEM_SCHEMA,
    TEMPORARY_SCHEMAS,
)


def catalog_filter(
    df: DataFrame, schema_col: str, exclude: tuple[str, ...] = (SYSTEM_SCHEMA,), exclude_like: str = TEMPORARY_SCHEMAS
) -> DataFrame:
    """Drop system and temporary schemas; rows without a schema name drop out too."""
    schema = F.col(schema_col)
    return df.where(~schema.isin(*exclude) & ~schema.like(exclude_like))


def internal_catalog(internal: DataFrame) -> DataFrame:
    """Internal tables with trimmed names."""
    schema, table = F.trim("schema"), F.trim("table")
    return catalog_filter(internal, "schema").select(
        F.col("table_id").cast("int").alias("table_id"),
        table.alias("table_name"),
        schema.alias("schema_name"),
        qualified(schema, table).alias("schema_table"),
        F.lit(CLUSTER_LOCATION).alias("location"),
        "encoded",
        "diststyle",
        "sortkey1",
        "max_varchar",
        "sortkey1_enc",
        "sortkey_num",
    )


def table_creation_times(class_info: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Creation time per internal table."""
    names = namespaces.select(F.col("oid").alias("relnamespace"), F.trim("nspname").alias("nspname"))
    known = catalog_filter(class_info.join(names, "relnamespace", "left"), "nspname")
    return known.select(
        F.col("reloid").cast("int").alias("table_id"),
        qualified(F.col("nspname"), F.trim("relname")).alias("schema_table"),
        F.col("relcreationtime").alias("table_creation_time"),
    )


def catalog_union(internal: DataFrame, creation_times: DataFrame, external: DataFrame) -> DataFrame:
    """All tables under one schema, distinct. External tables share one id and have no creation time."""
    times = creation_times.select("table_id", "table_creation_time")
    inside = (
        internal_catalog(internal)
        .join(times, "table_id", "left")
        .withColumn("objectsrc", F.lit(INTERNAL_TABLE))
    )
    schema, table = F.trim("schemaname"), F.trim("tablename")
    outside = external.select(
        F.lit(EXTERNAL_ID).alias("table_id"),
        table.alias("table_name"),
        schema.alias("schema_name"),
        qualified(schema, table).alias("schema_table"),
        F.lit(EXTERNAL_TABLE).alias("objectsrc"),
        "location",
        "input_format",
        "output_format",
        "serialization_lib",
        "serde_parameters",
        "compressed",
        "parameters",
    )
    both = inside.unionByName(outside, allowMissingColumns=True)
    return both.select(*TABLE_ATTRIBUTES).distinct()
