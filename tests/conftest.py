import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql.types import StructType

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """``frame(ddl, *rows)``: a DataFrame of literal rows; ``frame(ddl, dict, ...)`` fills missing columns with NULL."""

    def build(ddl, *rows):
        schema = StructType.fromDDL(ddl)
        full = [tuple(r.get(n) for n in schema.names) if isinstance(r, dict) else r for r in rows]
        return spark.createDataFrame(full, schema)

    return build


def ts(text):
    return dt.datetime.fromisoformat(text)


def d(text):
    return dt.date.fromisoformat(text)


def rows(df, *cols):
    """The rows as sorted tuples of ``cols``."""
    key = lambda r: tuple((v is not None, v) for v in r)
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=key)


__all__ = ["Row", "d", "rows", "ts"]
