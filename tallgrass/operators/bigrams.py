"""Counts of neighbouring words as stripes: one row for a first word, not one for a pair.

A task counts the bigrams of many lines at once and sends each first word with arrays of
its next words and their counts. These partial stripes are stored, so that the words with
many entries are known before anything moves. A word's rows meet in one shuffle; those of a
word with many entries are dealt by next word over slots of a bounded number of entries.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallgrass.session import importable, new_run_dir

#: Tokens that a task counts at once, entries that it adds at once, entries of a row, rows of a batch.
TOKENS_AT_ONCE = 1 << 22
ENTRIES_AT_ONCE = 1 << 18
ROW_ENTRIES = 500
BATCH_ROWS = 4_000
#: Slots for the entries that make a word a wide one.
FINER = 10

PARTIAL = "x string, ys array<string>, ns array<long>, total long, entries long"
DEALT = "x string, slot int, slots int, marginal long, ys array<string>, ns array<long>"
PAIRS = "x string, y string, n long, marginal long"
STRIPES = "x string, slot int, slots int, stripe map<string, double>"


class Partial(NamedTuple):
    """Stripes of single tasks ``(x, ys, ns, total, entries)``, stored below ``place``.

    A word has several rows: from each task, and one for ``ROW_ENTRIES`` next words.
    ``total`` is the sum of ``ns``, ``entries`` their number.
    """

    rows: DataFrame
    place: str


def partial_stripes(tokenized: DataFrame, place: str | None = None) -> Partial:
    """Count all bigrams by task; stored by default in the shared folder of the session."""
    importable(tokenized.sparkSession)
    place = place or new_run_dir(tokenized.sparkSession, "bigrams")
    return Partial(_stored(tokenized.select("tokens").mapInArrow(_counted, PARTIAL), f"{place}/partial"), place)


def _stored(table: DataFrame, place: str) -> DataFrame:
    table.write.mode("overwrite").parquet(place)
    return table.sparkSession.read.schema(table.schema).parquet(place)


def wide_words(partial: Partial, entries: int) -> DataFrame:
    """``(x, marginal, slots)`` of words with more than ``entries`` entries: at most one word for that many entries of all."""
    found = partial.rows.groupBy("x").agg(F.sum("total").alias("marginal"), F.sum("entries").alias("_weight"))
    slots = F.ceil(F.col("_weight") * FINER / F.lit(entries)).cast("int")
    return _stored(found.filter(F.col("_weight") > entries).select("x", "marginal", slots.alias("slots")), f"{partial.place}/wide")


def narrow_rows(partial: Partial, wide: DataFrame) -> DataFrame:
    """Rows of all other words: slot 0 has the whole word, so its marginal is the sum of what meets there."""
    rows = partial.rows.join(F.broadcast(wide), "x", "left_anti")
    nothing = F.lit(None).cast("long").alias("marginal")
    return rows.select("x", F.lit(0).alias("slot"), F.lit(1).alias("slots"), nothing, "ys", "ns")


def wide_rows(partial: Partial, wide: DataFrame) -> DataFrame:
    """Rows of the wide words, cut by a checksum of the next word into their slots."""
    rows = partial.rows.join(F.broadcast(wide), "x").select("x", "slots", "marginal", "ys", "ns")
    return rows.mapInArrow(_dealt, DEALT)


def merged(rows: DataFrame, form: str) -> DataFrame:
    """What is in the rows of a word and slot together, as ``PAIRS`` or as ``STRIPES`` whose values are shares of the marginal."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added(batches, form)

    return rows.repartition("x", "slot").sortWithinPartitions("x", "slot").mapInArrow(add, form)


def pair_rows(partial: Partial, entries: int) -> DataFrame:
    """``(x, y, n, marginal)`` of every bigram."""
    wide = wide_words(partial, entries)
    return merged(narrow_rows(partial, wide).unionByName(wide_rows(partial, wide)), PAIRS)


def stripe_rows(partial: Partial, max_entries: int) -> DataFrame:
    """``(x, block, stripe map<y, freq>)``; a word with up to ``max_entries`` next words has one row, block 0.

    The slots of a wide word are stored: the number of its next words, so that of its
    blocks, is known when they are merged. A block is some consecutive slots.
    """
    wide = wide_words(partial, max_entries)
    narrow = merged(narrow_rows(partial, wide), STRIPES).select("x", F.lit(0).alias("block"), "stripe")
    slots = _stored(merged(wide_rows(partial, wide), STRIPES), f"{partial.place}/slots")
    blocks = F.ceil(F.sum(F.size("stripe")) / F.lit(max_entries)).alias("_blocks")
    cut = slots.join(F.broadcast(slots.groupBy("x").agg(blocks)), "x")
    block = F.floor(F.col("slot") * F.col("_blocks") / F.col("slots")).cast("int").alias("block")
    stripe = F.map_from_entries(F.array_sort(F.flatten(F.collect_list("e")))).alias("stripe")
    return narrow.unionByName(cut.select("x", block, F.map_entries("stripe").alias("e")).groupBy("x", "block").agg(stripe))


# ---- inside tasks ----


def _whole(columns: list[pa.Array]) -> pa.Array:
    column = pa.chunked_array(columns).combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _coded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different words, ascending, and the number of each word among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy().astype(np.int64)]


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers start."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])


def _lists(starts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _batches(names: str, *columns: pa.Array) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_arrays(list(columns), [f.split()[0] for f in re.split(r", (?=\w+ )", names)])
    for at in range(0, len(batch), BATCH_ROWS):
        yield batch.slice(at, BATCH_ROWS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in filter(len, batches):
        held.append(batch.column(0))
        size += int(_lengths(batch.column(0)).sum())
        if size >= TOKENS_AT_ONCE:
            yield from _stripes(_whole(held))
            held, size = [], 0
    if held:
        yield from _stripes(_whole(held))


def _stripes(lines: pa.Array) -> Iterator[pa.RecordBatch]:
    words, number = _coded(lines.flatten())
    # The last word of a line starts no bigram.
    first = np.ones(len(number), bool)
    sizes = _lengths(lines)
    first[np.cumsum(sizes[sizes > 0]) - 1] = False
    at = np.flatnonzero(first)
    if not len(at):
        return
    keys = number[at] * len(words) + number[at + 1]
    keys.sort()
    runs = _starts(keys)
    times = np.diff(runs, append=len(keys))
    x, y = np.divmod(keys[runs], len(words))
    of_word = _starts(x)
    inside = np.arange(len(x)) - np.repeat(of_word, np.diff(of_word, append=len(x)))
    rows = np.flatnonzero(inside % ROW_ENTRIES == 0)
    yield from _batches(
        PARTIAL, words.take(pa.array(x[rows])), _lists(rows, words.take(pa.array(y))),
        _lists(rows, pa.array(times, pa.int64())), pa.array(np.add.reduceat(times, rows), pa.int64()),
        pa.array(np.diff(rows, append=len(x)), pa.int64()),
    )


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in filter(len, batches):
        x, slots, marginal, ys, ns = batch.columns
        words, number = _coded(ys.flatten())
        checksum = np.array([zlib.crc32(w.encode()) for w in words.to_pylist()], np.int64)
        row = np.repeat(np.arange(len(ys)), _lengths(ys))
        slot = checksum[number] % slots.to_numpy().astype(np.int64)[row]
        keys = row << 32 | slot
        order = np.argsort(keys, kind="stable")
        rows = _starts(keys[order])
        source = pa.array(row[order][rows])
        yield from _batches(
            DEALT, x.take(source), pa.array(slot[order][rows], pa.int32()), slots.take(source), marginal.take(source),
            _lists(rows, words.take(pa.array(number[order]))), _lists(rows, ns.flatten().take(pa.array(order))),
        )


def _added(batches: Iterator[pa.RecordBatch], form: str) -> Iterator[pa.RecordBatch]:
    """Rows come by word and slot; the last ones of a batch wait for more of theirs."""
    held, size = [], 0
    for batch in filter(len, batches):
        held.append(batch)
        size += int(_lengths(batch.column("ys")).sum())
        if size >= ENTRIES_AT_ONCE:
            table = _table(held)
            last = int(_groups(table)[-1])
            if last:
                yield from _sums(table.slice(0, last), form)
            held = [table.slice(last)]
            size = int(_lengths(held[0].column("ys")).sum())
    if held:
        yield from _sums(_table(held), form)


def _table(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_whole([b.column(i) for b in held]) for i in range(held[0].num_columns)], held[0].schema.names)


def _groups(table: pa.RecordBatch) -> np.ndarray:
    """Where the rows of another word or slot start."""
    x = table.column("x").dictionary_encode().indices.to_numpy().astype(np.int64)
    return _starts(x << 32 | table.column("slot").to_numpy().astype(np.int64))


def _sums(table: pa.RecordBatch, form: str) -> Iterator[pa.RecordBatch]:
    starts = _groups(table)
    words, number = _coded(table.column("ys").flatten())
    group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(table)))
    keys = np.repeat(group, _lengths(table.column("ys"))) * len(words) + number
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    runs = _starts(keys)
    times = np.add.reduceat(table.column("ns").flatten().to_numpy()[order], runs)
    group, y = np.divmod(keys[runs], len(words))
    rows = _starts(group)
    head = table.take(pa.array(starts))
    y = words.take(pa.array(y))
    marginal = pc.coalesce(head.column("marginal"), pa.array(np.add.reduceat(times, rows), pa.int64())).to_numpy()
    if form == PAIRS:
        yield from _batches(form, head.column("x").take(pa.array(group)), y, pa.array(times, pa.int64()), pa.array(marginal[group], pa.int64()))
    else:
        stripe = pa.MapArray.from_arrays(pa.array(np.append(rows, len(y)), pa.int32()), y, pa.array(times / marginal[group]))
        yield from _batches(form, head.column("x"), head.column("slot"), head.column("slots"), stripe)
