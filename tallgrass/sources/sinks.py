"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

_FORMATS = ("parquet", "json", "csv", "text")


def save(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite ``path``."""
    if fmt not in _FORMATS:
        raise ValueError(f"unknown format {fmt!r}: expected one of {_FORMATS}")
    df.write.mode("overwrite").format(fmt).save(path)


def save_sorted(df: DataFrame, path: str, keys: list[str], files: int, fmt: str = "parquet") -> None:
    """Overwrite ``path`` with ``files`` files laid out by ``keys``.

    Range partitioning over all the keys keeps files even when one value of the
    first key holds much of the data, and gives tight min/max statistics for
    lookups by that key.
    """
    save(df.repartitionByRange(files, *keys).sortWithinPartitions(*keys), path, fmt)
