"""Vectors as short codes: nearest codebook entries by sliced and intersected bit masks.

A vector is cut into ``PARTS`` equal parts, and each part is replaced by the number of
its nearest entry in that part's codebook. For each dimension of a part the entries'
coordinates are sorted, and a prefix mask says for each place in that order which
entries come before it, one bit each. The distance to the nearest of the entries just
above the vector in each dimension is the initial radius: all entries at most so far
away lie within it in every dimension, which is one range of the sorted coordinates and
so the difference of two prefix masks. These masks, ANDed over the dimensions, leave
the candidates, and the distances to them are exact integers. So every nearest entry,
and of equally near ones the lowest, is found.

Vectors stay where they are. Each round sums parts per entry inside the tasks, one row
for each entry that a task has met, and what reaches the driver is a codebook: at most
``ENTRIES`` rows for each part.

Defined cases: a null vector, and one with null or non-finite components, is dropped.
Vectors that are shorter than the longest, or than a multiple of ``PARTS``, are filled up
with zeros. The codebook starts from the smallest ids, each once; a repeated id gives its
first vector in the order of Spark's arrays, and a null id comes after all others. With
fewer ids the codebook is smaller. Null labels are one label. A component whose integer is
beyond ``LIMIT`` raises, since squares would overflow. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallgrass.llm.common import map_batches, stored
from tallgrass.operators.skew import lookup_join

PARTS = 16
ENTRIES = 64  # one bit each of a mask
SCALE = 256
ROUNDS = 2
LIMIT = 1 << 25
#: Vectors that a step works on.
_BLOCK = 1 << 13


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """Scaled and floored components, one row of ``width`` per vector, filled up with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * SCALE)
    if len(whole) and np.abs(whole).max() > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT // SCALE}")
    size = np.diff(np.asarray(vectors.offsets))
    out = np.zeros((len(vectors), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = whole.astype(np.int64)
    return out


def _distance(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((points - entries) ** 2).sum(axis=1)


class Masks:
    """The sorted coordinates and prefix masks of one part's entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        first = np.zeros((1, entries.shape[1]), np.uint64)
        self.before = np.concatenate([first, np.bitwise_or.accumulate(bits, axis=0)])

    def radius(self, points: np.ndarray) -> np.ndarray:
        """Squared distance to the nearest of the entries that come next in some dimension."""
        least = _distance(points, self.entries[0])
        for d in range(points.shape[1]):
            next_one = np.minimum(np.searchsorted(self.sorted[:, d], points[:, d]), len(self.entries) - 1)
            least = np.minimum(least, _distance(points, self.entries[self.order[next_one, d]]))
        return least

    def candidates(self, points: np.ndarray) -> np.ndarray:
        """A mask per point of the entries that are within its radius in every dimension."""
        squared = self.radius(points)
        reach = np.sqrt(squared.astype(np.float64)).astype(np.int64)
        reach += (reach + 1) ** 2 <= squared
        reach -= reach**2 > squared
        found = np.full(len(points), np.iinfo(np.uint64).max, np.uint64)
        for d in range(points.shape[1]):
            low = np.searchsorted(self.sorted[:, d], points[:, d] - reach, "left")
            high = np.searchsorted(self.sorted[:, d], points[:, d] + reach, "right")
            found &= self.before[high, d] ^ self.before[low, d]
        return found & self.before[-1, 0] if points.shape[1] else found & np.uint64(1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every point; ties go to the lower entry."""
        masks = self.candidates(points)
        bits = np.unpackbits(masks.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)
        distance = _distance(points[row], self.entries[entry])
        start = np.searchsorted(row, np.arange(len(points)))
        least = np.minimum.reduceat(distance, start) if len(points) else distance
        hit = np.flatnonzero(distance == least[row])
        first = hit[np.searchsorted(row[hit], np.arange(len(points)))]
        return entry[first], least


def assign(points: np.ndarray, books: list[Masks]) -> tuple[np.ndarray, np.ndarray]:
    """Entry and distance of each part of the rows of ``points``."""
    wide = points.shape[1] // PARTS
    entry = np.zeros((len(points), PARTS), np.uint8)
    distance = np.zeros((len(points), PARTS), np.int64)
    for part, book in enumerate(books):
        entry[:, part], distance[:, part] = book.nearest(points[:, part * wide : (part + 1) * wide])
    return entry, distance


def _blocks(batches, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), _BLOCK):
            some = batch.slice(at, _BLOCK)
            yield some, integers(some.column("_vector"), width)


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is whole and finite; the vector as ``_vector`` of doubles."""
    strange = F.exists("_vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select("vec_id", "label", F.col(vector).cast("array<double>").alias("_vector"))
    return rows.filter(F.col("_vector").isNotNull() & ~strange)


def first_books(rows: DataFrame, width: int) -> np.ndarray:
    """The vectors of the smallest ids, as codebooks ``parts x entries x dimensions``."""
    ids = rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(ENTRIES)
    # At most ENTRIES ids are broadcast; of each, every task keeps one vector.
    found = rows.join(F.broadcast(ids.withColumnRenamed("vec_id", "_id")), F.col("vec_id").eqNullSafe(F.col("_id")))
    found = found.groupBy("vec_id").agg(F.min("_vector").alias("_vector")).orderBy(F.col("vec_id").asc_nulls_last())
    points = integers(found.select("_vector").toArrow().column("_vector").combine_chunks(), width)
    return points.reshape(len(points), PARTS, width // PARTS).transpose(1, 0, 2)


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floored means of the parts nearest to them."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    width = books.shape[0] * books.shape[2]

    def run(batches):
        masks = [Masks(book) for book in shared.value]
        shape = shared.value.shape
        count, total = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
        for _, points in _blocks(batches, width):
            entry, _ = assign(points, masks)
            parts = points.reshape(len(points), shape[0], shape[2])
            for part in range(shape[0]):
                count[part] += np.bincount(entry[:, part], minlength=shape[1])
                np.add.at(total[part], entry[:, part], parts[:, part])
        part, at = np.nonzero(count)
        yield {
            "part": pa.array(part, pa.int64()),
            "entry": pa.array(at, pa.int64()),
            "n": pa.array(count[part, at], pa.int64()),
            "sums": pa.array(list(total[part, at]), pa.list_(pa.int64())),
        }

    sums = map_batches(rows.select("_vector"), run, "part long, entry long, n long, sums array<long>")
    each = sums.select("part", "entry", "n", F.posexplode_outer("sums").alias("_at", "_sum"))
    found = each.groupBy("part", "entry", "_at").agg(F.sum("_sum").alias("sum"), F.sum("n").alias("n")).toArrow()
    new = books.copy()
    part, entry, at, total, n = (found.column(c).to_numpy() for c in found.column_names)
    if books.shape[2]:
        new[part, entry, at.astype(np.int64)] = total // n  # floors go down
    return new


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(embeddings: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` per usable row, and the codebooks."""
    rows = usable(embeddings, vector)
    longest = rows.agg(F.max(F.size("_vector"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    books = first_books(rows, width)
    for _ in range(rounds if books.shape[1] else 0):
        books = refined(rows, books)
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        masks = [Masks(book) for book in shared.value]
        for some, points in _blocks(batches, width):
            entry, distance = assign(points, masks)
            yield {
                "vec_id": some.column("vec_id"),
                "label": some.column("label"),
                "code": pa.array([row.tobytes() for row in entry], pa.binary()),
                "error": pa.array(distance.sum(axis=1), pa.int64()),
            }

    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType(
        [
            T.StructField("vec_id", kinds["vec_id"]),
            T.StructField("label", kinds["label"]),
            T.StructField("code", T.BinaryType()),
            T.StructField("error", T.LongType()),
        ]
    )
    return map_batches(rows, run, schema), books


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id`` and ``components``, the integers that the codes stand for."""
    shared = codes.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for batch in batches:
            entry = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, PARTS)
            found = shared.value[np.arange(PARTS), entry].reshape(len(entry), -1)
            yield {"vec_id": batch.column("vec_id"), "components": pa.array(list(found), pa.list_(pa.int64()))}

    kind = codes.schema["vec_id"].dataType
    schema = T.StructType([T.StructField("vec_id", kind), T.StructField("components", T.ArrayType(T.LongType()))])
    return map_batches(codes.select("vec_id", "code"), run, schema)


def digests(embeddings: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``."""
    codes, books = compress(embeddings)
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("-"))
    codes = stored(codes.withColumn("_label", key), "codes")
    sums = codes.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows"))
    found = lookup_join(codes, sums, "_label", "_rows", ["vec_id", "error"])
    return found.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
