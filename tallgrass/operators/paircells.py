"""Counts of word pairs with little to shuffle.

A task counts the pairs of many stretches at once and sends each different pair of them
as one or two bytes. Words are dealt into groups by a checksum; a cell is a pair of
groups, a block ``SIDE`` x ``SIDE`` cells. For every block a task sends its words once
and for every cell, as packed gaps, the pairs in it; the counts of a cell are added
where its rows meet. So nothing that moves or is held grows with how often a pair
occurs, and no task has a list of all words.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallgrass.operators.buckets import estimated_bytes
from tallgrass.session import importable

#: Occurrences of pairs and of words that a task counts at once.
PAIRS_AT_ONCE = 1 << 26
WORDS_AT_ONCE = 1 << 22
#: Occurrences of pairs that it holds at once.
PAIRS_HELD = 1 << 22
#: Groups of words of a block, fewest groups, and bytes of input, as Spark estimates them, for a cell.
SIDE = 3
GROUPS = 33
CELL_BYTES = 2 << 20
#: Counts of one task, at most ``WORDS_AT_ONCE`` and a batch, take that many bits below the number of their pair.
COUNT_BITS = 23
LEVEL = 1

SENT = "x int, y int, part long, cell int, x_words binary, y_words binary, pairs binary, stretches long"
COUNTS = "x string, y string, n long, n_x long, n_y long, n_stretches long, kind string"


def groups_for(table: DataFrame) -> int:
    """How many groups of words: their cells grow with the input, so a cell stays within the memory of a task."""
    size = estimated_bytes(table) or 0
    return max(GROUPS, int((2 * size / CELL_BYTES) ** 0.5) // SIDE * SIDE)


def cell_counts(stretches: DataFrame, threshold: int) -> DataFrame:
    """``(x, y, n, n_x, n_y, n_stretches, kind)`` from ``stretches(words array<string>)`` whose words are different.

    Rows of the kind ``pair`` have ``x < y``, the stretches of both, of each and of all; of the
    kind ``word`` the word as ``y``; the ``total`` is a single row. Pairs and words in
    fewer than ``threshold`` stretches have none.
    """
    groups = groups_for(stretches)
    importable(stretches.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs, words = [], 0, 0
        part = TaskContext.get().partitionId() << 32
        for batch in filter(len, batches):
            column = batch.column(0)
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            held.append(column)
            pairs, words = pairs + int((sizes * (sizes - 1) // 2).sum()), words + int(sizes.sum())
            if pairs >= PAIRS_AT_ONCE or words >= WORDS_AT_ONCE:
                yield from _sent(held, groups, part)
                held, pairs, words, part = [], 0, 0, part + 1
        if held:
            yield from _sent(held, groups, part)

    def add(rows: pa.Table) -> pa.Table:
        return _added(rows, threshold)

    return stretches.mapInArrow(send, SENT).groupBy("x", "y").applyInArrow(add, COUNTS)


# ---- packed numbers and words ----


def _pack(numbers: np.ndarray) -> bytes:
    """Non-negative integers, byte by byte of all, so that the high ones vanish when compressed."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    planes = np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T)
    return bytes([kind.itemsize]) + zlib.compress(planes.tobytes(), LEVEL)


def _unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zlib.decompress(memoryview(data)[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"u{width}").ravel().astype(np.int64)


def _joined(*parts: bytes) -> bytes:
    return np.array([len(p) for p in parts], np.uint64).tobytes() + b"".join(parts)


def _parts(data: bytes, n: int) -> list[bytes]:
    ends = 8 * n + np.cumsum([0, *np.frombuffer(data, np.uint64, n).astype(np.int64)])
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _pack_words(words: list[bytes], counts: np.ndarray) -> bytes:
    lengths = np.array([len(w) for w in words], np.int64)
    return _joined(_pack(lengths), _pack(counts), zlib.compress(b"".join(words), LEVEL))


def _unpack_words(data: bytes) -> tuple[pa.Array, np.ndarray]:
    lengths, counts, text = _parts(data, 3)
    offsets = np.concatenate([[0], np.cumsum(_unpack(lengths))]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(zlib.decompress(text))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers), _unpack(counts)


# ---- sending ----


def _pairs_of(word: np.ndarray, stop: np.ndarray, low: int, high: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs whose first word is from ``low`` to below ``high``, as ``(first - low) * width + second``, and their counts.

    ``word`` holds the words of all stretches, ascending inside each; ``stop`` says where the stretch of each ends.
    """
    firsts = np.flatnonzero((word >= low) & (word < high))
    partners = stop[firsts] - firsts - 1
    before = np.cumsum(partners) - partners
    cuts = np.searchsorted(before, np.arange(PAIRS_HELD, int(partners.sum()), PAIRS_HELD))
    sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at, n in zip(np.split(firsts, cuts), np.split(partners, cuts)):
        to = np.arange(int(n.sum())) + np.repeat(at + 1 - (np.cumsum(n) - n), n)
        keys = np.repeat((word[at] - low) * width, n) + word[to]
        keys.sort()
        starts = _runs(keys)
        found = keys[starts], np.diff(starts, append=len(keys))
        sums = _summed(*map(np.concatenate, zip(sums, found))) if len(sums[0]) else found
    return sums


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers start."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])


def _sent(held: list[pa.Array], groups: int, part: int) -> Iterator[pa.RecordBatch]:
    column = pa.chunked_array(held).combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = column.flatten().dictionary_encode()
    words = [w.encode() for w in coded.dictionary.to_pylist()]
    times = np.bincount(coded.indices.to_numpy(), minlength=len(words))
    group = np.array([zlib.crc32(w) for w in words], np.int64) % groups
    # Numbers ascend by group; frequent words come first, so gaps are small, and words of one count by letters.
    by_letters = np.empty(len(words), np.int64)
    by_letters[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((by_letters, -times, group))
    words, times, group = [words[i] for i in order], times[order], group[order]
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(len(words))
    word = np.repeat(np.arange(len(sizes)), sizes) << 32 | number[coded.indices.to_numpy()]
    word.sort()
    word &= 0xFFFFFFFF
    stop = np.repeat(np.cumsum(sizes), sizes)
    del column, coded, by_letters, number
    ends = np.searchsorted(group, np.arange(0, groups + SIDE, SIDE))
    packed = [_pack_words(words[a:b], times[a:b]) for a, b in zip(ends, ends[1:])]
    yield _batch([(-1, -1, part, None, None, None, None, len(sizes))])
    # Every block gets its words, and with them all counts that its pairs need.
    for x in range(len(packed)):
        yield _batch([(x, y, part, None, packed[x], packed[y], None, len(sizes)) for y in range(x, len(packed))])
    for g in range(groups):
        x, (low, high) = g // SIDE, np.searchsorted(group, [g, g + 1])
        pairs, together = _pairs_of(word, stop, low, high, len(words))
        first, second = np.divmod(pairs, max(len(words), 1))
        first += low
        by_cell = np.argsort(group[second].astype(np.min_scalar_type(groups)), kind="stable")
        cells = np.searchsorted(group[second[by_cell]], np.arange(groups + 1))
        rows = []
        for h in range(g, groups):
            y, own = h // SIDE, by_cell[cells[h] : cells[h + 1]]
            if len(own):
                at = (first[own] - ends[x]) * (ends[y + 1] - ends[y]) + second[own] - ends[y]
                body = _joined(_pack(np.diff(at, prepend=0)), _pack(together[own]))
                rows.append((x, y, part, g * groups + h, None, None, body, None))
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    names = ["x", "y", "part", "cell", "x_words", "y_words", "pairs", "stretches"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


# ---- adding ----


def _numbered(packed: list[bytes]) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """The different words of all rows, the numbers of each row's words among them, and their counts."""
    found = [_unpack_words(data) for data in packed]
    coded = pa.chunked_array([w for w, _ in found], pa.large_string()).combine_chunks()
    coded = (coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int64)
    counts = np.bincount(numbers, np.concatenate([c for _, c in found]), len(coded.dictionary)).astype(np.int64)
    return coded.dictionary, np.split(numbers, np.cumsum([len(w) for w, _ in found])[:-1]), counts


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, with the sums of their times."""
    if not len(keys):
        return keys, times
    if keys.max() < 1 << (63 - COUNT_BITS) and times.max() < 1 << COUNT_BITS:
        both = keys << COUNT_BITS | times
        both.sort()
        keys, times = both >> COUNT_BITS, both & ((1 << COUNT_BITS) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
    starts = _runs(keys)
    return keys[starts], np.add.reduceat(times, starts)


def _added(rows: pa.Table, threshold: int) -> pa.Table:
    x, y = rows["x"][0].as_py(), rows["y"][0].as_py()
    n_stretches = pc.sum(rows["stretches"]).as_py()
    if x < 0:
        return _counts([""], [""], [n_stretches], [None], [None], n_stretches, "total")
    lists = rows.filter(pc.is_valid(rows["x_words"]))
    at = {part: i for i, part in enumerate(lists["part"].to_pylist())}
    x_words, x_numbers, n_x = _numbered(lists["x_words"].to_pylist())
    y_words, y_numbers, n_y = _numbered(lists["y_words"].to_pylist()) if x != y else (x_words, x_numbers, n_x)
    cells = defaultdict(list)
    for part, cell, body in zip(rows["part"].to_pylist(), rows["cell"].to_pylist(), rows["pairs"]):
        if cell is not None:
            cells[cell].append((at[part], body))
    found = []
    for bodies in cells.values():
        keys, times = _cell_sums(bodies, x_numbers, y_numbers, len(y_words), x == y)
        kept = times >= threshold
        first, second = np.divmod(keys[kept], len(y_words))
        left, right = x_words.take(pa.array(first)), y_words.take(pa.array(second))
        turned = pc.greater(left, right)
        n_first, n_second = pa.array(n_x[first]), pa.array(n_y[second])
        found.append(_counts(
            pc.if_else(turned, right, left), pc.if_else(turned, left, right), times[kept],
            pc.if_else(turned, n_second, n_first), pc.if_else(turned, n_first, n_second), n_stretches, "pair",
        ))
    if x == y:
        often = np.flatnonzero(n_x >= threshold)
        nothing = pa.nulls(len(often), pa.int64())
        found.append(_counts([""] * len(often), x_words.take(pa.array(often)), n_x[often], nothing, nothing, n_stretches, "word"))
    return pa.concat_tables(found) if found else _counts([], [], [], [], [], 0, "pair")


def _cell_sums(bodies: list[tuple[int, pa.Scalar]], x_numbers: list[np.ndarray], y_numbers: list[np.ndarray], width: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of a cell, as ``first * width + second``, and how often they occur in all."""
    sums, waiting, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
    for i, body in bodies:
        gaps, times = map(_unpack, _parts(body.as_py(), 2))
        first, second = np.divmod(np.cumsum(gaps), len(y_numbers[i]))
        first, second = x_numbers[i][first], y_numbers[i][second]
        if same:
            first, second = np.minimum(first, second), np.maximum(first, second)
        waiting.append((first * width + second, times))
        size += len(gaps)
        # Pairs that wait are added as soon as they are as many as those there: each moves few times.
        if size > max(len(sums[0]), PAIRS_HELD):
            sums, waiting, size = _summed(*map(np.concatenate, zip(sums, *waiting))), [], 0
    return _summed(*map(np.concatenate, zip(sums, *waiting))) if waiting else sums


def _counts(x, y, n, n_x, n_y, n_stretches: int, kind: str) -> pa.Table:
    def column(values, of):
        return values.cast(of) if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values, of)

    columns = [column(x, pa.string()), column(y, pa.string()), *[column(v, pa.int64()) for v in (n, n_x, n_y)]]
    columns += [pa.repeat(pa.scalar(n_stretches, pa.int64()), len(columns[0])), pa.repeat(pa.scalar(kind), len(columns[0]))]
    return pa.table(columns, names=["x", "y", "n", "n_x", "n_y", "n_stretches", "kind"])
