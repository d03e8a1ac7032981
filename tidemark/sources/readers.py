"""Parquet readers that apply the declared schemas, so no file is opened to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.contracts import INPUTS, TARGETS, empty_target
from tidemark.sources.manifests import RUN_COLUMN, Published, newest


def read_inputs(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Read the inputs stored as ``<root>/<name>`` Parquet datasets."""
    return {name: spark.read.schema(INPUTS[name]).parquet(f"{root}/{name}") for name in names or INPUTS}


def read_target(spark: SparkSession, root: str, name: str, run: Published | None = None) -> DataFrame:
    """A result table as the newest published run, or ``run``, left it; empty before the first."""
    folders = (run or newest(spark, root)).tables.get(name, [])
    if not folders:
        return empty_target(spark, name)
    reader = spark.read.schema(TARGETS[name]).option("basePath", f"{root}/{name}")
    return reader.parquet(*[f"{root}/{folder.path}" for folder in folders]).drop(RUN_COLUMN)
