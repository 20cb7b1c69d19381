"""Helpers shared by the operators of this subpackage.

Operators select the columns they need before anything else, so extra columns
of any name may stand beside them. Names with a leading underscore are theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallgrass.session import importable, new_run_dir

#: Bytes of text that one step of a mapper takes at once.
CHUNK_BYTES = 4 << 20
#: Copies of a row that one task makes at once.
COPIES = 1 << 14


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    The table outlives any executor, so nothing is computed twice after a loss.
    """
    spark = df.sparkSession
    place = new_run_dir(spark, label)
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """Tells rows with one ``doc_id`` but different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def as_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary array as one byte buffer, and the n + 1 offsets in it. Nulls are empty."""
    if array.null_count:
        array = array.fill_null(b"")
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``size`` bytes of ``column`` each; a longer value has a slice of its own."""
    _, offsets = as_bytes(batch.column(column))
    start = 0
    while start < len(batch):
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), len(batch))
        yield batch.slice(start, end - start)
        start = end


def map_batches(df: DataFrame, fn: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` over non-empty batches; ``fn`` maps an iterator of batches to an iterator of dicts of arrays."""

    names = [field.split()[0] for field in schema.split(", ")] if isinstance(schema, str) else schema.names

    def run(batches):
        for out in fn(b for b in batches if len(b)):
            yield pa.RecordBatch.from_pydict({n: out[n] for n in names})

    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def copied(rows: DataFrame, times: str, name: str) -> DataFrame:
    """Each row once for every number ``name`` from 1 to its ``times``, a long.

    Equal rows can so be counted inside the tasks before a shuffle and be made out again
    behind it. A row of more than ``COPIES`` is cut, and its parts go to several tasks.
    """
    one = F.lit(1).cast("long")
    few = rows.filter(F.col(times) <= COPIES).withColumn(name, F.explode(F.sequence(one, times)))
    starts = F.explode(F.sequence(one, times, F.lit(COPIES).cast("long")))
    parts = rows.filter(F.col(times) > COPIES).withColumn("_from", starts)
    parts = parts.repartition(*[c for c in rows.columns if c != times], "_from")
    many = parts.withColumn(name, F.explode(F.sequence("_from", F.least(F.col("_from") + (COPIES - 1), F.col(times)))))
    return few.unionByName(many.drop("_from"))


def without_repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with one row for each value of the long ``keys`` in each task: what many tasks repeat stays once per task.

    A shuffle by the keys that follows gets at most as many rows of one key as there are tasks.
    """

    def run(batches):
        seen: set = set()
        for batch in batches:
            fresh = []
            for key in zip(*(batch.column(k).to_pylist() for k in keys)):
                fresh.append(key not in seen)
                seen.add(key)
            some = batch.filter(pa.array(fresh, pa.bool_()))
            yield {n: some.column(n) for n in some.schema.names}

    return map_batches(rows, run, rows.schema)
