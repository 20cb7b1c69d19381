"""Exact deduplication by Grace hashing.

Equal means: identical after lower-casing A-Z only; a null text counts as
empty. Each task first drops repeats among its own rows, so a text that a third
of all rows share reaches the shuffle once per task. Contents then meet by
digest. A task whose contents do not fit into ``fit_bytes`` deals them to spill
files by further bits of the digest, again and again, until each bucket fits an
open-addressing table that compares complete contents.

Nulls, ties, repeats: a null ``doc_id`` is smaller than any other. Of rows that
repeat both text and ``doc_id``, exactly one is kept. An empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallgrass.llm.common import copied, map_batches, same
from tallgrass.operators.skew import lookup_join

FIT_BYTES = 48 << 20
FAN_OUT = 16
_LOWEST = -(1 << 63)


class ContentTable:
    """Open addressing with linear probing; keys are compared in full."""

    def __init__(self) -> None:
        self.slots: list[int] = [-1] * 1024
        self.rows: list[list] = []  # digest, content, largest id, rows
        self.bytes = 0

    def _slot(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (row := self.slots[at]) >= 0 and self.rows[row][1] != content:
            at = (at + 1) & mask
        return at

    def add(self, digest: bytes, content: bytes, largest: int, rows: int) -> None:
        at = self._slot(digest, content)
        if (known := self.slots[at]) >= 0:
            entry = self.rows[known]
            entry[2] = max(entry[2], largest)
            entry[3] += rows
            return
        self.slots[at] = len(self.rows)
        self.rows.append([digest, content, largest, rows])
        self.bytes += len(content) + 200
        if len(self.rows) * 2 > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for i, row in enumerate(self.rows):
                self.slots[self._slot(row[0], row[1])] = i


def grace_tables(records: Iterator[tuple], fit_bytes: int = FIT_BYTES, level: int = 0) -> Iterator[ContentTable]:
    """Tables that together hold every record, each distinct content in one of them.

    Records go to a table as long as it fits. After that, table and rest are
    dealt to ``FAN_OUT`` spill files by a nibble of the digest, and each file is
    treated the same way with the next nibble. One single content never spills:
    its repeats need no room.
    """
    found = ContentTable()
    for record in records:
        found.add(*record)
        if found.bytes > fit_bytes and len(found.rows) > 1 and level < 32:
            break
    else:
        yield found
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as place:  # of this task alone, gone with it
        files = [open(f"{place}/{i}", "w+b") for i in range(FAN_OUT)]

        def deal(record):
            nibble = record[0][level // 2] >> (4 * (level % 2)) & 15
            pickle.dump(tuple(record), files[nibble])

        for row in found.rows:
            deal(row)
        found = ContentTable()
        for record in records:
            deal(record)
        for file in files:
            file.seek(0)
            yield from grace_tables(_read(file), fit_bytes, level + 1)
            file.close()


def _read(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _normal(text: bytes | None) -> bytes:
    return (text or b"").lower()  # bytes: A-Z only


def _table_rows(found: ContentTable, with_content: bool) -> dict:
    digest, content, largest, rows = zip(*found.rows) if found.rows else ((), (), (), ())
    out = {"_sha": pa.array(digest, pa.binary())}
    if with_content:
        out["_content"] = pa.array(content, pa.binary())
    return out | {"_largest": pa.array(largest, pa.int64()), "_rows": pa.array(rows, pa.int64())}


def _local(batches):
    """Distinct contents of a task, flushed whenever they reach the bound."""
    found = ContentTable()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("_text").to_pylist()):
            content = _normal(text)
            found.add(hashlib.sha256(content).digest(), content, _LOWEST if doc_id is None else doc_id, 1)
            if found.bytes > FIT_BYTES // 4:
                yield _table_rows(found, True)
                found = ContentTable()
    yield _table_rows(found, True)


def _merged(batches):
    records = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("_sha", "_content", "_largest", "_rows"))))
    for found in grace_tables(records):
        yield _table_rows(found, False)


def _digests(batches):
    for batch in batches:
        shas = [hashlib.sha256(_normal(t)).digest() for t in batch.column("_text").to_pylist()]
        yield {c: batch.column(c) for c in batch.schema.names if c != "_text"} | {"_sha": pa.array(shas, pa.binary())}


def _binary(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select("doc_id", *more, F.col("text").cast("binary").alias("_text"))


def content_classes(docs: DataFrame) -> DataFrame:
    """One row per distinct content: ``_sha``, ``_largest`` (doc_id; the lowest long for null), ``_rows``."""
    local = map_batches(_binary(docs), _local, "_sha binary, _content binary, _largest long, _rows long")
    return map_batches(local.repartition("_sha"), _merged, "_sha binary, _largest long, _rows long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = map_batches(_binary(docs), _digests, "doc_id long, _sha binary")
    # Rows that repeat id and text are one row with a count until the end.
    rows = rows.groupBy("doc_id", "_sha").agg(F.count(F.lit(1)).alias("_times"))
    found = copied(lookup_join(rows, content_classes(docs), "_sha", "_rows", ["doc_id"]), "_times", "_nth")
    keep = F.when(F.col("_largest") != _LOWEST, F.col("_largest"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.col("_rows").alias("group_size"),
        (same(F.col("doc_id"), keep) & (F.col("_nth") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of equal texts, the largest ``doc_id``."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keyed = docs.withColumn("_key", F.unhex(F.sha2(F.coalesce(lowered, F.lit("")), 256)))
    keyed = keyed.withColumn("_id", F.coalesce("doc_id", F.lit(_LOWEST).cast("long")))
    stay = content_classes(docs).select(F.col("_sha").alias("_key"), F.col("_largest").alias("_id"))
    # Join and numbering have the same keys: whole rows move once.
    nth = F.row_number().over(Window.partitionBy("_key", "_id").orderBy("_key"))
    return keyed.join(stay, ["_key", "_id"]).withColumn("_nth", nth).filter("_nth = 1").select(*docs.columns)
