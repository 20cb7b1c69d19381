"""Shards by jump consistent hashing.

The shard follows from ``doc_id`` and the number of shards alone (law ``key``),
without a ring table; appending a shard moves only the rows that it takes.
A null ``doc_id`` counts as key 0, a null text as empty. Rows that repeat a
``doc_id`` share a shard. Empty tables give empty tables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallgrass.llm.common import copied, importable

LAW = "key"
#: Parts of a shard that are numbered apart, so that no task sorts a whole shard.
PARTS = 4096


def jump_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every 64-bit key."""
    key = keys.astype(np.int64).view(np.uint64).copy()
    shard, nxt = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = nxt[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        nxt[live] = ((shard[live] + 1) * step).astype(np.int64)
        live = live[nxt[live] < shards]
    return shard.astype(np.int32)


def jump_hash(key: str | Column, shards: int) -> Column:
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def shard_of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_shards(keys.to_numpy(), shards))

    return shard_of(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(0).cast("long")))


def with_shards(docs: DataFrame, shards: int, name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; no shuffle."""
    importable(docs.sparkSession)
    return docs.withColumn(name, jump_hash("doc_id", shards))


def write_shards(docs: DataFrame, shards: int, path: str) -> None:
    """One folder per shard below ``path``."""
    with_shards(docs, shards).write.partitionBy("shard").parquet(path)


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row.

    Slots number a shard's rows without gaps, in the order of a hash of id and text. Rows
    that are the same in all that is returned are one row with a count until the end, and
    parts of a shard are counted first, then numbered apart: neither a repeated row nor a
    repeated or null id makes a group of its own size.
    """
    importable(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_times"))
    order = F.xxhash64("doc_id", "text_crc32", "size")
    rows = rows.select("*", jump_hash("doc_id", shards).alias("shard"), order.alias("_order"))
    rows = rows.withColumn("_part", F.pmod("_order", F.lit(PARTS)))
    counts = rows.groupBy("shard", "_part").agg(F.sum("_times").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("shard", "_part").orderBy("_order", "doc_id", "text_crc32", "size")
    before = F.sum("_times").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("_before", F.coalesce(before, F.lit(0))).join(counts, ["shard", "_part"])
    grown = placed.withColumn("grown_shard", jump_hash("doc_id", shards + 1))
    return copied(grown, "_times", "_nth").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("_first") + F.col("_before") + F.col("_nth") - 1).alias("slot"), "grown_shard",
    )
