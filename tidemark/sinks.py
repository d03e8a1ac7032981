"""The load patterns, published as one.

A run writes every table into a folder of its own and never over data that it, or another reader, still reads. What was appended
before, what is replaced and what goes is only a matter of the folders that the run's manifest lists, and the manifest is
written last. A run that breaks off leaves folders that nothing lists; the tables stay those of the run before.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.manifests import RUN_COLUMN, RUNS, Folder, Published, file_system, names_in, published, write_manifest

#: Writes of one run at the same time.
AT_ONCE = 4


def stamp_of(run_ts: dt.datetime) -> str:
    return run_ts.strftime("%Y%m%dT%H%M%S%f")


def write_folder(df: DataFrame, path: str, by: str | None) -> None:
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)


class Loads:
    """The loads of one run on top of the published run ``base``; nothing shows before :meth:`publish`."""

    def __init__(self, spark: SparkSession, root: str, base: Published, run_ts: dt.datetime):
        self.spark, self.root, self.base, self.stamp = spark, root, base, stamp_of(run_ts)
        self.tables = {name: list(folders) for name, folders in base.tables.items()}
        self.writes: list[tuple[DataFrame, str, str | None]] = []

    def _folder(self, name: str, df: DataFrame, by: str | None, day: dt.date | None = None) -> Folder:
        folder = Folder(f"{name}/{RUN_COLUMN}={self.stamp}-{uuid.uuid4().hex[:8]}", day and day.isoformat())
        self.writes.append((df, f"{self.root}/{folder.path}", by))
        return folder

    def append(self, name: str, df: DataFrame, by: str | None = None) -> None:
        """Incremental append and insert-if-absent: ``df`` holds only the rows that are new."""
        self.tables[name] = [*self.tables.get(name, []), self._folder(name, df, by)]

    def append_day(self, name: str, df: DataFrame, by: str, day: dt.date, replace: bool) -> None:
        """Append the snapshot of one day; with ``replace`` it takes the place of what the same day's runs wrote."""
        stay = [f for f in self.tables.get(name, []) if not (replace and f.day == day.isoformat())]
        self.tables[name] = [*stay, self._folder(name, df, by, day)]

    def replace(self, name: str, df: DataFrame) -> None:
        """Replace a table that is rebuilt from others, or is a full state, on every run."""
        self.tables[name] = [self._folder(name, df, None)]

    def publish(self) -> Published:
        """Write everything, then the manifest."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for done in [pool.submit(write_folder, *write) for write in self.writes]:
                done.result()
        return write_manifest(self.spark, self.root, self.base, self.stamp, self.tables)


def remove_unlisted(spark: SparkSession, root: str, retain: int = 1) -> list[str]:
    """Remove older runs than the newest ``retain``, and what broken runs left; the folders removed.

    Folders stamped like the newest run or later stay: a run that is on its way may have written them.
    """
    runs = published(spark, root, retain)
    if not runs:
        return []
    numbers = {f"{run.number:08d}.json" for run in runs}
    listed = {folder.path for run in runs for folders in run.tables.values() for folder in folders}
    gone = [f"{RUNS}/{name}" for name in names_in(spark, f"{root}/{RUNS}") if name.endswith(".json") and name not in numbers and name < max(numbers)]
    for table in names_in(spark, root):
        if table != RUNS:
            gone += [path for name in names_in(spark, f"{root}/{table}") if name < f"{RUN_COLUMN}={runs[0].stamp}" and (path := f"{table}/{name}") not in listed]
    for path in gone:
        system, there = file_system(spark, f"{root}/{path}")
        system.delete(there, True)
    return gone
