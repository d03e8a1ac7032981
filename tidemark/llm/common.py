"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Code points on which Python's and the tokenizer library's character classes are known to agree:
#: Latin, Greek, Cyrillic, general punctuation, currency, CJK and Hangul.
PLAIN = re.compile("[\u0000-ԯ -⁯₠-₿　-鿿가-힣]*")

#: Latin script, where Python's own classes agree as well: no digits but 0 to 9, no control characters but white space.
LATIN = re.compile("[\t-\r -~\u00a0-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u024f]*")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder of spark.checkpoint.dir; without one, a private folder on a local master only."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        context.setCheckpointDir(named)
        return
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-llm-"))


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder.

    The files go once nothing refers to the result, if the session has spark.cleaner.referenceTracking.cleanCheckpoints=true;
    otherwise they stay until the folder is cleared.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes a DataFrame as a table into the shared folder and reads it back, until the block ends."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"

    def stored(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stored
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def task_id() -> int:
    return TaskContext.get().partitionId()


def row_key(number: int) -> int:
    """A key unique among all rows of a stage: the task's partition above, the row's place below."""
    return (task_id() << 40) + number


def rows_of(batches: Iterator[pa.RecordBatch], at_once: int = 256) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples; so many at once become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, at_once):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, at_once).columns), strict=True)


def load_tokenizer(path: str):
    """A tokenizer of the tokenizers library; in a task it keeps to the task's own core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


class Rows:
    """Collects output rows and hands them on as Arrow batches of a bounded number of rows."""

    def __init__(self, schema: pa.Schema, limit: int = 20_000):
        self.schema, self.limit = schema, limit
        self.columns: list[list] = [[] for _ in schema]

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)

    def full(self) -> bool:
        return len(self.columns[0]) >= self.limit

    def take(self) -> pa.RecordBatch:
        arrays = [pa.array(column, field.type) for column, field in zip(self.columns, self.schema, strict=True)]
        self.columns = [[] for _ in self.schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def crc_fold(doc_id: str, parts: int):
    """Column: crc32 of the id's text modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def byte_level(piece: str) -> str:
    """A piece of text as a byte-level model spells it: one printable character per byte."""
    if piece.isascii():
        if piece.isalnum():
            return piece
        if piece[0] == " " and piece[1:].isalnum():
            return "\u0120" + piece[1:]
    return "".join(map(BYTES.__getitem__, piece.encode()))


def _spelling() -> list[str]:
    """Printable bytes stand for themselves, the others for the characters from U+0100 on, in order."""
    others = iter(range(0x100, 0x200))
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return [chr(b if b in printable else next(others)) for b in range(0x100)]


BYTES = _spelling()
