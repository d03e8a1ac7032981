"""Session helpers: a local session for tests and durable intermediate results."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate results; a private one only for local runs that name none.

    ``setCheckpointDir`` comes before spark.checkpoint.dir. On a cluster, this machine's own folder for
    temporary files is refused.
    """
    local = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        place = urlsplit(root)
        if not local and place.scheme in ("", "file") and f"{place.path}/".startswith(f"{tempfile.gettempdir()}/"):
            raise RuntimeError(f"{root} is this machine's own: set {CHECKPOINT_DIR} to a folder that every executor can reach")
        return root.rstrip("/")
    if not local:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(root)
    return root


#: The folder that owns the intermediate results of the run at hand; runs at the same time have one each.
_owner: ContextVar[str | None] = ContextVar("owner", default=None)


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[str]:
    """Own all that :func:`durable` writes within the block, and remove it at its end.

    What is returned from the block must have been stored before, for nothing durable outlives it. A thread
    that the block starts belongs to it if it runs in a copy of the block's context.
    """
    folder = f"{checkpoint_root(spark)}/tidemark/{uuid.uuid4().hex}"
    before = _owner.set(folder)
    try:
        yield folder
    finally:
        _owner.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_bytes(df: DataFrame) -> Column:
    """Column: a rough upper bound of one row's size in memory."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    fixed = F.lit(16 * (len(df.columns) + 1)).cast("bigint")
    return reduce(lambda total, c: total + F.coalesce(F.octet_length(c), F.lit(0)), wide, fixed)


def durable(df: DataFrame, **metrics: Column) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Used where a result is read more than once and must not change in between, also when
    executors are lost. Parquet instead of ``checkpoint()`` so that later readers can prune
    columns. Within :func:`intermediates` the files go when the block ends; otherwise they stay as
    long as the caller wants to read the result. Its size, and ``metrics`` (aggregates), are
    observed by the write itself: see :func:`measured`.
    """
    spark = df.sparkSession
    path = f"{_owner.get() or checkpoint_root(spark) + '/tidemark'}/{uuid.uuid4().hex}"
    seen = Observation()
    size = F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")
    df.observe(seen, size, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]).write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._tidemark_measured = seen.get
    return kept


def lasting(df: DataFrame) -> DataFrame:
    """:func:`durable`, but owned by no run: the files also stay when an :func:`intermediates` block that this is called in ends."""
    before = _owner.set(None)
    try:
        return durable(df)
    finally:
        _owner.reset(before)


def measured(df: DataFrame) -> dict | None:
    """What the write of a durable result observed: ``bytes``, ``rows`` and further metrics; None for other DataFrames."""
    return df.__dict__.get("_tidemark_measured")


def no_larger(df: DataFrame, *than: DataFrame) -> DataFrame:
    """``df``, known to take no more memory than the durable results ``than`` together."""
    sizes = [measured(other) for other in than]
    if all(sizes):
        df._tidemark_measured = {"bytes": sum(size["bytes"] for size in sizes)}
    return df
