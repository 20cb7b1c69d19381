"""Text corpora as lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def lines_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Split documents into numbered lines: ``(key, line_no, value)``."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "value"))
