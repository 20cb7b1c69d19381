"""Removal of repeated passages by a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller ``doc_id``. Every such string (window) has an anchor:
its ``GRAM``-byte piece with the smallest hash, the leftmost of equals. Equal
windows have equal anchors, so windows meet by anchor, and neighbouring windows
with one anchor travel as one stretch of text:

1. Each document is cut into stretches. Anchors travel as 32 bits and a row
   number; those of at least two documents mark their stretches as candidates.
2. Texts of candidate stretches meet by anchor. Equal stretches need no sorting.
   Windows of different stretches with one anchor are suffixes to be sorted:
   a mergesort whose comparisons find the common extension of two suffixes by
   binary search over prefix polynomial hashes. Neighbours in that order whose
   extension reaches ``LENGTH`` are compared byte by byte (a hash collision sends
   the whole part to a comparison of bytes) and form classes. All of a class but
   its smallest document lose the window.
3. The lost spans of a document are joined with its text.

Stretches with equal texts are settled inside each task first: all but the smallest
document of the task lose them there and then, so per task and text one stretch
remains, whatever the number of documents. Where a shared passage meets other text in
every document, the stretches over its edges have one anchor and different texts. Such
anchors are counted over all documents. The stretches of the ``HOT_ANCHORS`` largest
with more than ``HOT`` different stretches are cut into single windows, which are
settled inside the task too and then meet by the hash of their ``LENGTH`` bytes: equal
windows are one per task, different ones go to different parts. Any other anchor
has at most ``HOT`` such stretches or 1 / ``HOT_ANCHORS`` of all, and besides one
for each ``CHUNK_BYTES`` of text.

Defined cases: a null text is empty; rows with a null ``doc_id`` lose nothing and
take nothing from others; rows that repeat a ``doc_id`` take nothing from each
other; texts below ``LENGTH`` bytes stay whole. Empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallgrass.llm.common import as_bytes, chunks, map_batches

LENGTH = 50
GRAM = 24
#: Documents are worked on in pieces of so many window starts, counted from their first byte.
PIECE = 1 << 19
#: Stretches, or bytes of their texts, that a task packs together.
BLOCK = 1 << 20
BLOCK_BYTES = 16 << 20
#: Bytes of text that are sorted together, unless one anchor has more.
SORT_BYTES = 1 << 20
#: An anchor with more different stretches than this is dealt by single windows.
HOT = 8192
HOT_ANCHORS = 65_536
#: Windows of hot anchors that a task works on together.
HOT_WINDOWS = 1 << 18
#: In place of an anchor's offset: a single window, dealt by its own bytes.
_ALONE = 255
_LOWEST = -(1 << 63)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POSITION = np.uint64((1 << 20) - 1)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            factors = np.full(size, _BASE, np.uint64)
            factors[0] = 1
            self.up = np.multiply.accumulate(factors)
            factors[1:] = _INVERSE
            self.down = np.multiply.accumulate(factors)
        return self.up, self.down


POWERS = Powers()


def prefix_hashes(text: np.ndarray) -> np.ndarray:
    """``n + 1`` sums of ``(byte + 1) * base ** position``."""
    up, _ = POWERS.upto(len(text) + 1)
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=out[1:])
    return out


def gram_hashes(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The hashes that :func:`stretches` gives the pieces of ``GRAM`` bytes at these places."""
    up, _ = POWERS.upto(GRAM)
    total = np.zeros(len(at), np.uint64)
    for i in range(GRAM):
        total += (text[at + i].astype(np.uint64) + np.uint64(1)) * up[i]
    return _mixed(total)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def stretches(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of concatenated pieces: ``start``, ``windows``, anchor's ``offset`` and ``hash``.

    ``ends``: where each piece ends. Windows do not cross ends.
    """
    none = np.zeros(0, np.int64)
    if len(text) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    prefix = prefix_hashes(text)
    _, down = POWERS.upto(len(text) + 1)
    grams = len(text) - GRAM + 1
    gram = _mixed((prefix[GRAM:] - prefix[:-GRAM]) * down[:grams])
    least = gram & ~_POSITION | np.arange(grams, dtype=np.uint64)
    width, span = LENGTH - GRAM + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: span - width], least[width - span :])
    anchor = (least & _POSITION).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    sizes = np.maximum(ends - starts - LENGTH + 1, 0)
    first = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    window = np.arange(sizes.sum()) + first
    at = anchor[window]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(window) != 1)])) if len(at) else none
    start = window[new]
    return start, np.diff(np.append(new, len(at))), at[new] - start, gram[at[new]]


def _pieces(values: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts as concatenated pieces: bytes, ends, document and first byte of each piece."""
    group: list[tuple[int, int, int]] = []
    held = 0
    for doc in range(len(offsets) - 1):
        size = int(offsets[doc + 1] - offsets[doc])
        for at in range(0, max(size - LENGTH + 1, 0), PIECE):
            take = min(PIECE + LENGTH - 1, size - at)
            if held + take > PIECE + LENGTH and group:
                yield _joined(values, offsets, group)
                group, held = [], 0
            group.append((doc, at, take))
            held += take
    if group:
        yield _joined(values, offsets, group)


def _joined(values, offsets, group):
    doc, at, take = np.array(group, np.int64).T
    text = np.concatenate([values[offsets[d] + a : offsets[d] + a + t] for d, a, t in group])
    return text, np.cumsum(take), doc, at


def cut(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of texts: document, start inside it, windows, anchor's offset and hash; by document and start."""
    found = []
    for text, ends, doc, at in _pieces(values, offsets):
        start, windows, offset, anchor = stretches(text, ends)
        piece = np.searchsorted(ends, start, "right")
        begin = np.concatenate([[0], ends[:-1]])[piece]
        found.append((doc[piece], start - begin + at[piece], windows, offset, anchor))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _packed(part: np.ndarray, parts: int, columns: dict[str, np.ndarray]) -> dict:
    """One row per part with each column's values as bytes. ``part`` must be sorted."""
    counts = np.bincount(part, minlength=parts)
    used = np.flatnonzero(counts)
    ends = np.concatenate([[0], np.cumsum(counts[used])])
    out = {"part": pa.array(used.astype(np.int32))}
    for name, values in columns.items():
        out[name] = _slices(values, ends)
    return out


def _slices(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer((ends * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(batches, kinds: dict[str, type]) -> list[np.ndarray]:
    parts = {name: [] for name in kinds}
    for batch in batches:
        for name, kind in kinds.items():
            parts[name].append(as_bytes(batch.column(name))[0].view(kind) if len(batch) else np.zeros(0, kind))
    return [np.concatenate(p) if p else np.zeros(0, kinds[n]) for n, p in parts.items()]


# ---- 1: candidates ----

_ASK = {"anchor": np.uint32, "row": np.int64, "runs": np.int32, "low": np.uint16, "high": np.uint16, "known": np.uint8}


def _anchor_part(anchor: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of an anchor, and 32 other bits that tell anchors inside a part apart.

    Anchors are least hashes, so they are mixed again. Parts grow in number, not in
    size, so a part's chance meetings stay as rare; they make needless candidates.
    """
    mixed = _mixed(anchor * _BASE)
    return ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64), mixed.astype(np.uint32)


def _questions(parts: int):
    def block(rows, start, anchor):
        # An anchor of several documents here is known to be shared: one stretch of it
        # still asks on behalf of other tasks, all others go anywhere.
        order = np.argsort(anchor, kind="stable")
        same = anchor[order][1:] == anchor[order][:-1]
        fresh = np.concatenate([[True], ~same])
        group = np.cumsum(fresh) - 1
        row = rows[order]
        first = row[np.flatnonzero(fresh)][group]
        several = np.zeros(group[-1] + 1, bool)
        several[group[row != first]] = True
        known = np.empty(len(order), np.uint8)
        known[order] = np.where(several[group], np.where(fresh, 2, 1), 0)
        part, rest = _anchor_part(anchor, parts)
        part = np.where(known == 1, rows % parts, part)
        by = np.argsort(part, kind="stable")
        return _packed_rows(part[by], parts, rest[by], rows[by], start[by], known[by])

    def _packed_rows(part, many, anchor, rows, start, known):
        counts = np.bincount(part, minlength=many)
        used = np.flatnonzero(counts)
        ends = np.concatenate([[0], np.cumsum(counts[used])])
        # Documents follow each other: each as its row number and how many stretches it has.
        turn = np.concatenate([[True], (rows[1:] != rows[:-1]) | (part[1:] != part[:-1])])
        heads = np.flatnonzero(turn)
        runs = np.diff(np.append(heads, len(rows)))
        run_ends = np.concatenate([[0], np.cumsum(np.bincount(part[heads], minlength=many)[used])])
        return {
            "part": pa.array(used.astype(np.int32)),
            "anchor": _slices(anchor, ends),
            "row": _slices(rows[heads], run_ends),
            "runs": _slices(runs.astype(np.int32), run_ends),
            "low": _slices((start & 0xFFFF).astype(np.uint16), ends),
            "high": _slices((start >> 16).astype(np.uint16), ends),
            "known": _slices(known, ends),
        }

    def run(batches):
        held, many = [], 0
        for batch in batches:
            for slice_ in chunks(batch):
                rows = slice_.column("row").to_numpy()
                doc, start, _, _, anchor = cut(*as_bytes(slice_.column("text")))
                held.append((rows[doc], start, anchor))
                many += len(doc)
                if many > BLOCK:
                    yield block(*(np.concatenate(x) for x in zip(*held)))
                    held, many = [], 0
        if many:
            yield block(*(np.concatenate(x) for x in zip(*held)))

    return run


def _answers(parts: int):
    return lambda batches: _shared(batches, parts)


def _shared(batches, parts):
    """Stretches whose anchor several documents have."""
    anchor, heads, runs, low, high, known = _unpacked(batches, _ASK)
    if not len(low):
        return
    rows = np.repeat(heads, runs)
    start = low.astype(np.int32) | high.astype(np.int32) << 16
    asked = np.flatnonzero(known != 1)
    asked = asked[np.argsort(anchor[asked], kind="stable")]
    fresh = np.concatenate([[True], anchor[asked][1:] != anchor[asked][:-1]]) if len(asked) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    shared = np.zeros(int(group[-1]) + 1 if len(group) else 0, bool)
    shared[group[known[asked] == 2]] = True
    first = rows[asked][np.flatnonzero(fresh)][group] if len(asked) else rows[:0]
    shared[group[rows[asked] != first]] = True
    got = np.concatenate([np.flatnonzero(known == 1), asked[shared[group]]])
    yield _by_part(rows[got], start[got], parts)


def _by_part(rows: np.ndarray, values: np.ndarray, parts: int) -> dict:
    """Numbers of documents, packed by the part that gathers a document."""
    part = rows % parts
    by = np.lexsort((rows, part))
    return _packed(part[by], parts, {"row": rows[by], "value": values[by].astype(np.int32)})


def _gathered(batches):
    """All numbers of a document as one row."""
    rows, values = _unpacked(batches, {"row": np.int64, "value": np.int32})
    by = np.lexsort((values, rows))
    rows, values = rows[by], values[by]
    heads = np.flatnonzero(np.diff(rows, prepend=rows[0] - 1)) if len(rows) else np.zeros(0, np.int64)
    yield {"row": pa.array(rows[heads], pa.int64()), "starts": _slices(values, np.append(heads, len(rows)))}


# ---- 2: texts of candidates ----

_TEXTS = {"doc": np.int64, "row": np.int64, "start": np.int32, "windows": np.uint8, "offset": np.uint8}


def _settle(texts: list[bytes], doc: np.ndarray) -> np.ndarray:
    """Which stretches are not in the smallest document that has their whole text."""
    least: dict[bytes, int] = {}
    for text, d in zip(texts, doc.tolist()):
        if d < least.get(text, d + 1):
            least[text] = d
    return doc > np.fromiter(map(least.__getitem__, texts), np.int64, len(texts))


_SPANS = {"doc": np.int64, "row": np.int64, "span": np.int32}


def _lost(doc, row, begin, end, parts) -> dict:
    """Spans to remove, packed by the part that gathers a document."""
    order = np.lexsort((begin, doc, row))
    doc, row, begin, end = doc[order], row[order], begin[order], end[order]
    # Spans that touch the one before are one; what this misses, the last step joins.
    fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] > end[:-1])])
    heads = np.flatnonzero(fresh) if len(row) else np.zeros(0, np.int64)
    end = np.maximum.reduceat(end, heads) if len(heads) else end
    doc, row, begin = doc[heads], row[heads], begin[heads]
    part = row % parts
    by = np.argsort(part, kind="stable")
    spans = np.stack([begin[by], end[by]], axis=1).astype(np.int32)
    counts = np.bincount(part, minlength=parts)
    used = np.flatnonzero(counts)
    ends = np.concatenate([[0], np.cumsum(counts[used])])
    out = {"part": pa.array(used.astype(np.int32)), "doc": _slices(doc[by], ends), "row": _slices(row[by], ends)}
    return out | {"span": _slices(spans.reshape(-1), ends * 2)}


def _spans_of(batches):
    """All spans of a document as one row, disjoint and in order."""
    doc, row, flat = _unpacked(batches, _SPANS)
    if not len(doc):
        return
    spans = flat.reshape(-1, 2)
    by = np.lexsort((spans[:, 0], doc, row))
    doc, row, spans = doc[by], row[by], spans[by]
    turn = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (doc[1:] != doc[:-1])]))
    ends = np.append(turn, len(row))
    yield {"row": pa.array(row[turn]), "doc": pa.array(doc[turn]), "spans": _slices(spans.reshape(-1), ends * 2)}


def _frequent(batches):
    """Anchors with different stretches in one chunk of text, and how many."""
    for batch in batches:
        for slice_ in chunks(batch):
            values, offsets = as_bytes(slice_.column("text"))
            doc, start, windows, _, anchor = cut(values, offsets)
            _, kind, many = np.unique(anchor, return_inverse=True, return_counts=True)
            some = np.flatnonzero(many[kind] > 1)
            begin = offsets[doc[some]] + start[some]
            whole = values.tobytes()
            ends = begin + windows[some] + LENGTH - 1
            # Equal texts have equal anchors: each text is looked at once.
            first: dict[bytes, int] = {}
            for i, a, b in zip(some.tolist(), begin.tolist(), ends.tolist()):
                first.setdefault(whole[a:b], i)
            found, many = np.unique(anchor[list(first.values())], return_counts=True) if first else (anchor[:0], windows[:0])
            several = many > 1
            yield {"anchor": pa.array(found[several].view(np.int64)), "many": pa.array(many[several].astype(np.int64))}


def hot_anchors(texts: DataFrame) -> np.ndarray:
    """The hashes, sorted, of the ``HOT_ANCHORS`` anchors with most different stretches, if those are more than ``HOT``."""
    counts = map_batches(texts.select("text"), _frequent, "anchor long, many long")
    counts = counts.groupBy("anchor").agg(F.sum("many").alias("many")).filter(F.col("many") > HOT)
    found = counts.orderBy(F.desc("many"), "anchor").limit(HOT_ANCHORS).select("anchor").toArrow()
    return np.sort(found.column("anchor").to_numpy().view(np.uint64))


def _window_hashes(texts: list[bytes]) -> np.ndarray:
    """Hashes of texts of ``LENGTH`` bytes."""
    up, _ = POWERS.upto(LENGTH)
    table = np.frombuffer(b"".join(texts), np.uint8).reshape(-1, LENGTH)
    total = np.zeros(len(table), np.uint64)
    for i in range(LENGTH):
        total += (table[:, i].astype(np.uint64) + np.uint64(1)) * up[i]
    return _mixed(total)


def _alone(doc, row, start, windows, texts):
    """Stretches as single windows, some at a time: ``doc, row, start, windows, offset, texts``."""
    turn = np.cumsum(windows) // HOT_WINDOWS
    for some in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(turn)) + 1):
        many = windows[some]
        which = np.repeat(some, many)
        at = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        single = [texts[i][a : a + LENGTH] for i, a in zip(which.tolist(), at.tolist())]
        ones = np.ones(len(which), np.int64)
        yield doc[which], row[which], start[which] + at, ones, ones * _ALONE, single


def _texts(parts: int, hot: np.ndarray):
    """Candidates' texts, packed by part; what is settled here leaves as spans."""

    def block(anchor, doc, row, start, windows, offset, texts):
        gone = _settle(texts, doc)
        yield from settled(gone, doc, row, start, windows)
        many = ~gone & np.isin(anchor, hot)
        keep = np.flatnonzero(~gone & ~many)
        yield from sent(keep, anchor[keep], doc, row, start, windows, offset, texts)
        many = np.flatnonzero(many)
        if len(many):
            for single in _alone(doc[many], row[many], start[many], windows[many], [texts[i] for i in many.tolist()]):
                gone = _settle(single[-1], single[0])
                yield from settled(gone, *single[:4])
                keep = np.flatnonzero(~gone)
                yield from sent(keep, _window_hashes([single[-1][i] for i in keep.tolist()]), *single)

    def settled(gone, doc, row, start, windows):
        if gone.any():
            lost = _lost(doc[gone], row[gone], start[gone], start[gone] + windows[gone] + LENGTH - 1, parts)
            yield lost | {f"_{n}": pa.nulls(len(lost["part"]), pa.binary()) for n in (*_TEXTS, "text")}

    def sent(keep, dealt_by, doc, row, start, windows, offset, texts):
        part, _ = _anchor_part(dealt_by, parts)
        keep = keep[np.argsort(part, kind="stable")]
        part = np.sort(part, kind="stable")
        columns = {"doc": doc, "row": row, "start": start.astype(np.int32), "windows": windows.astype(np.uint8), "offset": offset.astype(np.uint8)}
        out = _packed(part, parts, {f"_{n}": v[keep] for n, v in columns.items()})
        lengths = (windows[keep] + LENGTH - 1).astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        counts = np.bincount(part, minlength=parts)
        ends = upto[np.concatenate([[0], np.cumsum(counts[np.flatnonzero(counts)])])]
        whole = b"".join([texts[i] for i in keep.tolist()])
        # Overlapping pieces of text are most of what this operator moves.
        pack = zstandard.ZstdCompressor(3).compress
        out["_text"] = pa.array([pack(whole[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())
        yield out | {n: pa.nulls(len(out["part"]), pa.binary()) for n in _SPANS}

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for slice_ in chunks(batch):
                values, offsets = as_bytes(slice_.column("text"))
                marks = [np.frombuffer(x, np.int32) for x in slice_.column("starts").to_pylist()]
                doc, start, windows, offset, anchor = cut(values, offsets)
                wanted = np.concatenate([m.astype(np.int64) + (i << 32) for i, m in enumerate(marks)])
                hit = np.flatnonzero(np.isin(doc << 32 | start, wanted))
                doc, start, windows, offset, anchor = (x[hit] for x in (doc, start, windows, offset, anchor))
                ids, rows = slice_.column("doc").to_numpy(), slice_.column("row").to_numpy()
                whole = values.tobytes()
                begin = offsets[doc] + start
                texts = [whole[a:b] for a, b in zip(begin.tolist(), (begin + windows + LENGTH - 1).tolist())]
                held.append((anchor, ids[doc], rows[doc], start, windows, offset, texts))
                size += int(windows.sum()) + LENGTH * len(texts)
                if size > BLOCK_BYTES:
                    yield from block(*_stacked(held))
                    held, size = [], 0
        if size:
            yield from block(*_stacked(held))

    return run


def _stacked(held):
    *arrays, texts = zip(*held)
    return *(np.concatenate(x) for x in arrays), [t for part in texts for t in part]


# ---- the suffix sort ----


def common_extension(prefix: np.ndarray, down: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """How many bytes the suffixes at ``a`` and ``b`` share, ``limit`` at most: binary search over hashes."""
    shared = np.zeros(len(a), np.int64)
    pa_, pb, da, db = prefix[a], prefix[b], down[a], down[b]
    step = 1 << (limit.bit_length() - 1)
    while step:
        longer = shared + step
        fits = np.minimum(longer, limit)
        equal = ((prefix[a + fits] - pa_) * da == (prefix[b + fits] - pb) * db) & (longer <= limit)
        shared = np.where(equal, longer, shared)
        step >>= 1
    return shared


def sort_suffixes(text: np.ndarray, starts: np.ndarray, group: np.ndarray, limit: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by ``group`` (sorted, from 0) and first ``limit`` bytes, and the
    common extension of each with the one before in its group.

    Bottom-up mergesort of all groups at once. In each round an element finds its
    place in the neighbouring run by binary search; a comparison is logarithmic.
    """
    prefix = prefix_hashes(text)
    _, down = POWERS.upto(len(text) + 1)
    n = len(starts)
    size = np.bincount(group)
    base = (np.cumsum(size) - size)[group]
    size, order = size[group], np.arange(n)
    padded = np.append(text, 0)

    def before(a, b):  # is the suffix at a smaller
        shared = common_extension(prefix, down, a, b, limit)
        return (shared < limit) & (padded[a + shared] < padded[b + shared])

    run = 1
    live = np.flatnonzero(size > run)
    while len(live):
        local = live - base[live]
        mine = local // run
        other = (mine ^ 1) * run
        low = np.minimum(other, size[live])
        high = np.minimum(other + run, size[live])
        floor = low.copy()
        left = (mine & 1) == 0
        me = starts[order[live]]
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            it = starts[order[base[live[open_]] + middle]]
            mine_at = me[open_]
            # Equal suffixes of a left run stay before those of the right one.
            is_left = left[open_]
            smaller = before(np.where(is_left, it, mine_at), np.where(is_left, mine_at, it))
            onward = np.where(is_left, smaller, ~smaller)
            low[open_] = np.where(onward, middle + 1, low[open_])
            high[open_] = np.where(onward, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        place = base[live] + (mine >> 1) * 2 * run + (local - mine * run) + (low - floor)
        merged = order.copy()
        merged[place] = order[live]
        order = merged
        run *= 2
        live = np.flatnonzero(size > run)
    shared = np.zeros(n, np.int64)
    pair = np.flatnonzero(np.concatenate([[False], group[1:] == group[:-1]])) if n else np.zeros(0, np.int64)
    shared[pair] = common_extension(prefix, down, starts[order[pair]], starts[order[pair - 1]], limit)
    return order, shared


def window_classes(text: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Equal numbers for windows of one group with equal bytes."""
    order, shared = sort_suffixes(text, starts, group)
    windows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    joined = np.flatnonzero(shared >= LENGTH)
    for at in range(0, len(joined), 1 << 18):
        some = joined[at : at + (1 << 18)]
        if not np.array_equal(windows[starts[order[some]]], windows[starts[order[some - 1]]]):
            return _by_bytes(windows[starts], group)  # two texts with one hash
    number = np.empty(len(starts), np.int64)
    number[order] = np.cumsum(shared < LENGTH)
    return number


def _by_bytes(windows: np.ndarray, group: np.ndarray) -> np.ndarray:
    keyed = np.concatenate([group.astype(">i8").view(np.uint8).reshape(-1, 8), windows], axis=1)
    return np.unique(np.ascontiguousarray(keyed).view(f"V{keyed.shape[1]}").ravel(), return_inverse=True)[1]


def lost_windows(texts: list[bytes], doc: np.ndarray, anchor: np.ndarray, windows: np.ndarray, offset: np.ndarray):
    """For each stretch and window: index of the stretch, and the window, that a smaller document has too."""
    order = np.argsort(anchor, kind="stable")
    _, kind = np.unique(anchor, return_inverse=True)
    # Equal texts of one document are one here.
    first: dict[bytes, int] = {}
    for i in order.tolist():
        first.setdefault(texts[i], i)
    twin = np.fromiter(map(first.__getitem__, texts), np.int64, len(texts))
    own = order[twin[order] == order]
    if not len(own):
        return own, own
    own = own[np.bincount(kind[own], minlength=kind.max() + 1)[kind[own]] > 1]
    # Anchors by and by, so that the text under the sort stays bounded.
    lengths = windows[own] + LENGTH - 1
    turn = np.flatnonzero(np.diff(kind[own], prepend=-1))
    upto = np.append(np.cumsum(lengths)[turn[1:] - 1], lengths.sum()) if len(own) else lengths
    which, window = [twin[:0]], [twin[:0]]
    at = 0
    while at < len(turn):
        done = upto[at - 1] if at else 0
        end = max(int(np.searchsorted(upto, done + SORT_BYTES, "right")), at + 1)
        some = own[turn[at] : turn[end] if end < len(turn) else len(own)]
        i, w = _sorted_out(some, texts, doc, kind, windows, offset)
        which.append(some[i])
        window.append(w)
        at = end
    which, window = np.concatenate(which), np.concatenate(window)
    # Back to every stretch with that text.
    twins = np.argsort(twin, kind="stable")
    many = np.bincount(twin, minlength=len(texts))
    copies = many[which]
    at = np.repeat((np.cumsum(many) - many)[which], copies)
    index = at + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    return twins[index], np.repeat(window, copies)


def _sorted_out(own, texts, doc, kind, windows, offset):
    """Windows of the stretches ``own``, whole anchors, that a smaller document has."""
    lengths = windows[own] + LENGTH - 1
    text = np.frombuffer(b"".join([texts[i] for i in own.tolist()]), np.uint8)
    begin = np.cumsum(lengths) - lengths
    which = np.repeat(np.arange(len(own)), windows[own])
    window = np.arange(len(which)) - np.repeat(np.cumsum(windows[own]) - windows[own], windows[own])
    # Equal windows have their anchor at the same place.
    _, group = np.unique(kind[own][which] * 64 + offset[own][which] - window, return_inverse=True)
    several = np.bincount(group)[group] > 1
    which, window, group = which[several], window[several], group[several]
    if not len(which):
        return which, window
    by = np.argsort(group, kind="stable")
    which, window = which[by], window[by]
    _, group = np.unique(group[by], return_inverse=True)
    _, number = np.unique(window_classes(text, begin[which] + window, group), return_inverse=True)
    least = np.full(number.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, doc[own][which])
    hit = doc[own][which] > least[number]
    return which[hit], window[hit]


def _compared(parts: int):
    return lambda batches: _differing(batches, parts)


def _differing(batches, parts):
    given = []
    for batch in batches:
        done = batch.filter(pa.compute.is_valid(batch.column("span")))
        if len(done):
            yield {n: done.column(n) for n in ("part", *_SPANS)}
        given.append(batch.filter(pa.compute.is_null(batch.column("span"))))
    given = [b.rename_columns([n[1:] if n[0] == "_" else f"-{n}" for n in b.schema.names]) for b in given if len(b)]
    doc, row, start, windows, offset = _unpacked(given, _TEXTS)
    if not len(doc):
        return
    unpack = zstandard.ZstdDecompressor().decompress
    whole = b"".join([unpack(t) for b in given for t in b.column("text").to_pylist()])
    given.clear()
    windows, offset, start = windows.astype(np.int64), offset.astype(np.int64), start.astype(np.int64)
    ends = np.cumsum(windows + LENGTH - 1)
    texts = [whole[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]
    gone = _settle(texts, doc)
    spans = [(doc[gone], row[gone], start[gone], start[gone] + windows[gone] + LENGTH - 1)]
    # Equal windows that came alone are settled now; the others stay in their documents.
    alone = offset == _ALONE
    anchor = gram_hashes(np.frombuffer(whole, np.uint8), ends - (windows + LENGTH - 1) + np.where(alone, 0, offset))
    keep = np.flatnonzero(~gone & ~alone)
    which, window = lost_windows([texts[i] for i in keep.tolist()], doc[keep], anchor[keep], windows[keep], offset[keep])
    which = keep[which]
    by = np.lexsort((window, which))
    which, window = which[by], window[by]
    turn = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (np.diff(window) != 1)])) if len(which) else which
    last = np.append(turn[1:], len(which)) - 1 if len(which) else which
    spans.append((doc[which[turn]], row[which[turn]], start[which[turn]] + window[turn], start[which[turn]] + window[last] + LENGTH))
    yield _lost(*(np.concatenate(x) for x in zip(*spans)), parts)


# ---- 3: texts without the spans ----


def merged_spans(packed: list[bytes] | None) -> np.ndarray:
    """Disjoint spans, in order, that cover the same bytes; spans that touch are one."""
    spans = np.frombuffer(b"".join(packed or []), np.int32).reshape(-1, 2)
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], reach[np.append(np.flatnonzero(new)[1:], len(spans)) - 1]], axis=1)


def _kept(batches):
    for batch in batches:
        for part in chunks(batch):
            removed, texts = [], []
            for text, packed in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                spans = merged_spans(packed)
                at, rest = 0, []
                for begin, end in spans.tolist():
                    rest.append(text[at:begin])
                    at = end
                rest.append(text[at:])
                removed.append(spans.reshape(-1).tolist())
                texts.append(b"".join(rest))
            ids = part.column("doc")
            yield {
                "doc_id": pa.compute.if_else(pa.compute.equal(ids, _LOWEST), pa.scalar(None, pa.int64()), ids),
                "n_bytes": pa.array([len(t) for t in part.column("text").to_pylist()], pa.int64()),
                "spans": pa.array(removed, pa.list_(pa.int32())),
                "kept": pa.array(texts, pa.binary()),
            }


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans`` (begins and ends of removed runs, flat) ``, kept`` (the remaining bytes) per row."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = F.coalesce("doc_id", F.lit(_LOWEST).cast("long"))
    keyed = docs.select(doc.alias("doc"), F.xxhash64(doc, text).alias("row"), text.cast("binary").alias("text"))
    asked = map_batches(
        keyed.filter(F.col("doc") != _LOWEST).select("row", "text"), _questions(parts),
        "part int, anchor binary, row binary, runs binary, low binary, high binary, known binary",
    )
    shared = map_batches(asked.repartitionById(parts, F.col("part")), _answers(parts), "part int, row binary, value binary")
    marked = map_batches(shared.repartitionById(parts, F.col("part")), _gathered, "row long, starts binary")
    given = keyed.join(marked.hint("shuffle_hash"), "row", "left").filter("starts is not null")
    packed = ", ".join(f"{n} binary" for n in _SPANS)
    sent = map_batches(
        given.select("doc", "row", "text", "starts"), _texts(parts, hot_anchors(keyed.filter(F.col("doc") != _LOWEST))),
        f"part int, {packed}, " + ", ".join(f"_{n} binary" for n in (*_TEXTS, "text")),
    )
    lost = map_batches(sent.repartitionById(parts, F.col("part")), _compared(parts), f"part int, {packed}")
    lost = map_batches(lost.repartitionById(parts, F.col("part")), _spans_of, "row long, doc long, spans binary")
    spans = lost.groupBy("row").agg(F.collect_list(F.struct("doc", "spans")).alias("lost"))
    # Both joins have the same shuffle of the texts, which Spark makes once.
    whole = keyed.join(spans.hint("shuffle_hash"), "row", "left")
    own = F.transform(F.filter("lost", lambda x: x["doc"] == F.col("doc")), lambda x: x["spans"])
    whole = whole.select("doc", "text", own.alias("spans"))
    return map_batches(whole, _kept, "doc_id long, n_bytes long, spans array<int>, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row."""
    found = without_repeats(docs)
    return found.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
