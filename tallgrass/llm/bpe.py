"""Byte-level BPE encoding and decoding.

A pre-token's byte positions are the leaves of a segment tree. A leaf holds the
merge rank of the pair that starts there, packed with its position; the root is
the leftmost minimum. A merge takes the root and updates three leaves, each along
its path: the pair that begins at the merged token, the one that vanished and
the one of the live neighbour before. Short pre-tokens of one tree size are
merged side by side, a row of an array each; a long one has a tree of its own, so
its cost grows as n log n.

Ranks come from a file of a public tokenizer, named by a parameter; nothing is
trained. Each task keeps the ids of pre-tokens it has seen, up to a bound.
A null text is empty and gives no ids; any bytes that are valid UTF-8 come back
unchanged. Ties in rank go to the leftmost pair. Empty tables give empty tables.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F

from tallgrass.llm.common import chunks, map_batches

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Leaves of the largest tree that is one row of an array.
WIDEST = 64
#: Pre-tokens that a task remembers at most, and those merged side by side.
REMEMBERED = 400_000
ROWS = 1 << 15
_NONE = np.int32(1 << 30)


class Vocabulary:
    """Token bytes by id, and the id that two neighbouring ids merge into."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.bytes = [b""] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            self.bytes[rank] = token
        self.decimal = [b"%d" % i for i in range(len(self.bytes))]
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        self.merges = {}
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    self.merges[left << 20 | right] = rank
        pairs = sorted(self.merges.items())
        self.pairs = np.array([p for p, _ in pairs], np.int64)
        self.ranks = np.array([r for _, r in pairs], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or ``_NONE``; negative ids mean no token."""
        pair = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_one(token: bytes, vocab: Vocabulary) -> list[int]:
    """The ids of one pre-token of any length, with a tree of its own."""
    n = len(token)
    ids = [int(vocab.of_byte[b]) for b in token]
    width = 1 << max(n - 1, 1).bit_length()
    none = (1 << 40, 0)
    tree = [none] * (2 * width)
    rank = lambda i, j: (r, i) if i >= 0 and j < n and (r := vocab.merges.get(ids[i] << 20 | ids[j])) is not None else none
    for i in range(n - 1):
        tree[width + i] = rank(i, i + 1)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def put(i, value):
        node = width + i
        tree[node] = value
        while node > 1:
            node //= 2
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1] is not none and tree[1] != none:
        merged, i = tree[1]
        j = after[i]
        ids[i], live[j] = merged, False
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        put(j, none)
        put(i, rank(i, after[i]))
        if before[i] >= 0:
            put(before[i], rank(before[i], i))
    return [x for x, alive in zip(ids, live) if alive]


def merge_rows(tokens: list[bytes], width: int, vocab: Vocabulary) -> list[np.ndarray]:
    """The ids of many pre-tokens of at most ``width`` bytes, one tree per row."""
    m, bits = len(tokens), width.bit_length() - 1
    lengths = np.fromiter(map(len, tokens), np.int64, m)
    inside = np.arange(width) < lengths[:, None]
    ids = np.full((m, width + 1), -1, np.int32)
    ids[:, :width][inside] = vocab.of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
    place = np.arange(width, dtype=np.int32)
    tree = np.full((m, 2 * width), _NONE, np.int32)
    # Neighbours by position; ``width`` stands for none on either side.
    after = np.where(np.arange(1, width + 1) < lengths[:, None], np.arange(1, width + 1), width)
    after = np.concatenate([after, np.full((m, 1), width)], axis=1).astype(np.int32)
    before = np.tile(np.concatenate([[width], np.arange(width)]).astype(np.int32), (m, 1))

    def packed(row, i, j):
        rank = vocab.rank_of(ids[row, i], ids[row, j])
        return np.where(rank < _NONE, rank << bits | i, _NONE)

    first, second = ids[:, :width].ravel(), ids[:, 1:].ravel()
    rank = vocab.rank_of(first, second).reshape(m, width)
    tree[:, width:] = np.where(rank < _NONE, rank << bits | place, _NONE)
    for low in (width >> k for k in range(1, bits + 1)):
        tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
    row = np.flatnonzero(tree[:, 1] < _NONE)
    while len(row):
        best = tree[row, 1]
        i = best & (width - 1)
        j = after[row, i]
        ids[row, i], ids[row, j] = best >> bits, -1
        k = after[row, j]
        after[row, i] = k
        before[row, k] = i
        p = before[row, i]
        tree[row, width + j] = _NONE
        tree[row, width + i] = packed(row, i, k)
        has = p < width
        rows_p, p = row[has], p[has]
        tree[rows_p, width + p] = packed(rows_p, p, i[has])
        for nodes, rows in ((width + j, row), (width + i, row), (width + p, rows_p)):
            for _ in range(bits):
                nodes = nodes >> 1
                tree[rows, nodes] = np.minimum(tree[rows, 2 * nodes], tree[rows, 2 * nodes + 1])
        row = row[tree[row, 1] < _NONE]
    flat = ids[:, :width]
    alive = flat >= 0
    return np.split(flat[alive], np.cumsum(alive.sum(axis=1))[:-1])


class Encoder:
    """Ids of whole texts; remembers pre-tokens, as bytes of int32 ids."""

    def __init__(self, path: str) -> None:
        self.vocab = vocabulary(path)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, bytes] = {}

    def learn(self, tokens: set[str]) -> None:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for token in tokens:
            raw = token.encode()
            whole = self.vocab.ids.get(raw)
            if len(raw) == 1 and whole is not None:
                self.known[token] = np.int32(whole).tobytes()
            elif len(raw) > WIDEST:
                self.known[token] = np.array(merge_one(raw, self.vocab), np.int32).tobytes()
            else:
                by_width.setdefault(1 << max(len(raw) - 1, 1).bit_length(), []).append((token, raw))
        for width, group in by_width.items():
            for at in range(0, len(group), ROWS):
                part = group[at : at + ROWS]
                for (token, _), ids in zip(part, merge_rows([raw for _, raw in part], width, self.vocab)):
                    self.known[token] = ids.tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = [self.pattern.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set().union(*found).difference(self.known)
        self.learn(new)
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, tokens)), np.int32) for tokens in found]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocab.bytes.__getitem__, ids.tolist()))

    def decimal(self, ids: np.ndarray) -> bytes:
        return b",".join(map(self.vocab.decimal.__getitem__, ids.tolist()))


def _path(ranks: str) -> str:
    return ranks if "/" in ranks else public_tokenizers.path(ranks)


def _encoded(batches, ranks):
    """Pairs of a slice of a batch and the ids of its texts."""
    encoder = Encoder(_path(ranks))
    for batch in batches:
        for part in chunks(batch):
            yield encoder, part, encoder.encode([t or "" for t in part.column("text").to_pylist()])


def encode(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, ids`` per row of ``docs``."""

    def run(batches):
        for _, part, ids in _encoded(batches, ranks):
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield {"doc_id": part.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(sizes), pa.array(values, pa.int32()))}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; a null list is empty. Ids outside the vocabulary raise."""

    def run(batches):
        encoder = Encoder(_path(ranks))
        for batch in batches:
            texts = [encoder.decode(np.array(x or [], np.int32)) for x in batch.column("ids").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "text": pa.array([t.decode(errors="replace") for t in texts], pa.string())}

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes, decodes the ids and hashes both, in one pass."""

    def run(batches):
        for encoder, part, ids in _encoded(batches, ranks):
            yield {
                "doc_id": part.column("doc_id"),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(encoder.decimal(x)).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(encoder.decode(x)).hexdigest() for x in ids], pa.string()),
            }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select("doc_id", F.col("text")), run, schema)
