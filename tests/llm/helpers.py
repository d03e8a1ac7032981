"""Small tables for the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TESTDATA = "/root/testdata/sf0.001"

#: Awkward texts: null, empty, white space, special strings, scripts, controls, repeats.
TEXTS = [
    None, "", "   \n\t ", "a", "Hello, world! It's fine.", "Hello, world! It's fine.", "<|endoftext|> tail <|startoftext|>",
    "naïve café ΑΣ Σσς İstanbul ß ﬁ ½ ² ª", "日本語 と 한국어 और हिन्दी", "é combining ‍ joiner", "\x00\x1c\x1d\x85 controls\r\n",
    "x" * 5000, "ab " * 4000, "1234567890 " * 50, "!!! ??? ...", "  leading and trailing  ", "😀 emoji 👩‍👩‍👧", "ࡰ࢏ new letters",
]


def documents(spark: SparkSession, texts: list[str | None] = TEXTS) -> DataFrame:
    """doc_id, text and columns whose names the operators use themselves."""
    rows = [(i, t, "x", i, None) for i, t in enumerate(texts)]
    rows += [(None, "no id", "x", 1, None), (3, "a", "x", 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, key long, spans string")


def nothing(spark: SparkSession) -> DataFrame:
    return documents(spark).where("false")
