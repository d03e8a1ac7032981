"""Which folders make up the result tables: one manifest per run, of which readers follow the newest.

A manifest is a small JSON file below ``<root>/_runs``, numbered without gaps by the runs that were published. It names, for each
table, the folders to read, so a run counts as a whole or not at all. A file that is cut short is no manifest.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import SparkSession

RUNS = "_runs"
#: Folders are named like values of a partition column, by which Spark reads several of them as one table.
RUN_COLUMN = "run"


class Folder(NamedTuple):
    """A folder below the root that one run wrote, and the day it holds if it holds a single one."""

    path: str
    day: str | None = None


class Published(NamedTuple):
    """What a run published: its number, its stamp and the folders of each table."""

    number: int
    stamp: str
    tables: dict[str, list[Folder]]


NOTHING = Published(0, "", {})


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder in order; none if there is no such folder. No file is opened."""
    system, folder = file_system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(folder)) if system.exists(folder) else []


def _read(spark: SparkSession, root: str, name: str) -> Published | None:
    system, path = file_system(spark, f"{root}/{RUNS}/{name}")
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return Published(found["number"], found["stamp"], {t: [Folder(*f) for f in folders] for t, folders in found["tables"].items()})


def published(spark: SparkSession, root: str, last: int = 1) -> list[Published]:
    """The ``last`` newest manifests under ``root``, the newest first."""
    found: list[Published] = []
    for name in reversed(names_in(spark, f"{root}/{RUNS}")):
        if len(found) == last:
            break
        if name.endswith(".json") and (manifest := _read(spark, root, name)):
            found.append(manifest)
    return found


def newest(spark: SparkSession, root: str) -> Published:
    return next(iter(published(spark, root)), NOTHING)


def write_manifest(spark: SparkSession, root: str, base: Published, stamp: str, tables: dict[str, list[Folder]]) -> Published:
    """Publish a run that continues ``base``; refused if another run was published meanwhile.

    The file is made only if none has its number, so of two runs that continue the same one exactly one is published.
    """
    there = [int(name.split(".")[0]) for name in names_in(spark, f"{root}/{RUNS}") if name.endswith(".json")]
    if newest(spark, root).number != base.number:
        raise RuntimeError(f"another run was published under {root} since its state was read")
    run = Published(max(there, default=0) + 1, stamp, tables)
    system, path = file_system(spark, f"{root}/{RUNS}/{run.number:08d}.json")
    stream = system.create(path, False)
    try:
        stream.write(bytearray(json.dumps(run._asdict()).encode()))
    finally:
        stream.close()
    return run
