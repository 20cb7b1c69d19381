"""Quality by nearest-neighbour voting in a latent space.

A text's terms are runs of ``GRAM`` bytes of the lower-cased text, hashed to
``GRAMS`` terms, which tell its words in any script, and trigrams of byte classes
(letters, digits, kinds of punctuation, breaks), which tell its form. The
square-rooted frequencies of each kind, times idf of the sample and less their mean in
it, are projected to ``RANK`` latent dimensions, the leading singular vectors of a bounded
sample of labelled rows (``LABELLED`` at most, chosen by a hash of the id, never from the
held-out fifth). Without the mean the first direction would be the mean text and all
cosines near 1. The sample's vectors are broadcast: at most ``LABELLED * RANK`` numbers. For every document the cosine with each of them is computed exactly, in
blocks, and the labels of the ``NEIGHBOURS`` nearest are weighed by similarity.

Label, language, source and id are no inputs of a score. Defined cases: a null or
empty text, and one of less than three bytes, has the sample's mean label as its score;
so has every text when there are no labels (then 1, so that nothing is rejected).
Repeated label rows of a document count once, by their largest label; of several
texts with one id, the one with the smallest hash is in the sample. Ties among
neighbours go to the earlier in the sample. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallgrass.llm.common import as_bytes, chunks, map_batches, stored

LABELLED = 4000
RANK = 48
NEIGHBOURS = 25
THRESHOLD = 0.3
HELD_OUT = 5
_SHARPNESS = 4
_BLOCK = 1024
#: Blocks of the sample: so many tasks work on it, and so many partial sums reach the driver.
SAMPLE_BLOCKS = 8
# Byte classes, the first that fits; all others are class 0.
_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", bytes(range(128, 256)), b"0123456789",
    b" ", b"\n", b".,;:?'\"", b"!", b"|", b"#$%&*@^~", b"()[]{}<>=/\\-_+`",
)
WIDE = len(_CLASSES) + 1
FORMS = WIDE**3
GRAM = 4
GRAMS = 4096
TERMS = FORMS + GRAMS
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64)


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for number, members in enumerate(_CLASSES, 1):
        table[list(members)] = number
    return table


_TABLE = _class_table()


def _counts(codes: np.ndarray, offsets: np.ndarray, reach: int, wide: int) -> np.ndarray:
    """Counts per text of the codes of runs of ``reach`` bytes that end in the text they begin in."""
    many = len(offsets) - 1
    if not len(codes):
        return np.zeros((many, wide))
    doc = np.repeat(np.arange(many), np.diff(offsets))
    inside = doc[: len(codes)] == doc[reach - 1 :]
    return np.bincount((doc[: len(codes)] * wide + codes)[inside], minlength=many * wide).reshape(many, wide).astype(np.float64)


def term_counts(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of counts per text: trigrams of classes, then hashed runs of bytes."""
    classes = _TABLE[values]
    forms = (classes[:-2] * WIDE + classes[1:-1]) * WIDE + classes[2:]
    lower, runs = _LOWER[values], np.zeros(max(len(values) - GRAM + 1, 0), np.uint64)
    for i in range(GRAM):
        runs = runs << np.uint64(8) | lower[i : i + len(runs)]
    # The upper bits of a product with 2^64 / golden ratio.
    runs = (runs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)).astype(np.int64)
    return np.concatenate([_counts(forms, offsets, 3, FORMS), _counts(runs, offsets, GRAM, GRAMS)], axis=1)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares of each kind of terms."""
    kinds = counts[:, :FORMS], counts[:, FORMS:]
    return np.concatenate([np.sqrt(k / np.maximum(k.sum(axis=1, keepdims=True), 1)).astype(np.float32) for k in kinds], axis=1)


def _rows(texts: pa.Array) -> Iterator[np.ndarray]:
    """Frequencies of a few texts at a time, so that a table of them stays small."""
    for at in range(0, len(texts), _BLOCK):
        yield frequencies(term_counts(*as_bytes(texts.slice(at, _BLOCK))))


class Model(NamedTuple):
    projection: np.ndarray  # terms x rank, idf included
    shift: np.ndarray  # the mean text of the sample, projected
    vectors: np.ndarray  # labelled x rank, unit length
    labels: np.ndarray
    mean: float


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def vote(model: Model, rows: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of rows of frequencies, by exact cosines in blocks."""
    out = np.full(len(rows), model.mean)
    many = min(neighbours, len(model.vectors))
    if not many:
        return out
    known = np.flatnonzero(rows.any(axis=1))
    for at in range(0, len(known), _BLOCK):
        some = known[at : at + _BLOCK]
        cosine = _unit(rows[some] @ model.projection - model.shift) @ model.vectors.T
        least = np.partition(cosine, -many, axis=1)[:, -many, None]
        level = cosine == least  # of those, the earliest
        near = (cosine > least) | level & (level.cumsum(axis=1) <= many - (cosine > least).sum(axis=1, keepdims=True))
        weight = np.where(near, np.maximum(cosine, 0), 0).astype(np.float64) ** _SHARPNESS
        total = weight.sum(axis=1)
        out[some] = np.where(total > 0, weight @ model.labels / np.maximum(total, 1e-12), model.mean)
    return np.clip(out, 0.0, 1.0)


def held_out():
    """Every fifth document by the checksum of its id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """``doc_id, _label, _row`` of at most ``labelled`` rows: the term frequencies of one text per id, stored in blocks."""
    known = labels.filter("doc_id is not null and quality is not null").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("_label"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                found = [r.tobytes() for rows in _rows(part.column("text")) for r in rows.astype(np.float16)]
                yield {"doc_id": part.column("doc_id"), "_label": part.column("_label"), "_row": pa.array(found, pa.binary())}

    # ``labelled`` ids at most are broadcast. Of an id with several rows each task keeps one, and so does the whole.
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id")
    one = texts.groupBy("doc_id", "_label").agg(F.min(F.struct(F.xxhash64("text").alias("key"), "text")).alias("_one"))
    one = one.select("doc_id", "_label", F.col("_one.text").alias("text"))
    rows = map_batches(one, run, "doc_id long, _label int, _row binary")
    return stored(rows.repartition(SAMPLE_BLOCKS, "doc_id").sortWithinPartitions("doc_id"), "sample")


def _over(sample: DataFrame, work: Callable) -> list[np.ndarray]:
    """``work(rows, labels)`` of every block of the sample, in one order whichever task was first. Only its results reach the driver."""

    def run(batches):
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column("_row").to_pylist()), np.float16).reshape(-1, TERMS)
            found = np.ascontiguousarray(work(rows.astype(np.float32), batch.column("_label").to_numpy()))
            yield {"first": batch.column("doc_id").slice(0, 1), "wide": pa.array([found.shape[1]]), "found": pa.array([found.astype(np.float32).tobytes()])}

    got = map_batches(sample, run, "first long, wide long, found binary").toArrow()
    got = got.sort_by("first") if len(got) else got
    return [np.frombuffer(f, np.float32).reshape(-1, w) for f, w in zip(got.column("found").to_pylist(), got.column("wide").to_pylist())]


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rank: int = RANK) -> Model:
    """Randomised singular vectors (fixed start, three power steps) of the centred rows of the sample.

    The rows stay in their blocks: tasks multiply them with a basis, and sums of terms x
    (``rank`` + 8) numbers, then one latent vector per row, come to the driver.
    """
    sample = labelled_sample(docs, labels, labelled)
    context = sample.sparkSession.sparkContext
    blocks = _over(sample, lambda rows, label: np.stack([(rows > 0).sum(axis=0), rows.sum(axis=0)]))
    known = _over(sample, lambda rows, label: label[:, None])
    if not known:
        nothing = np.zeros((0, 1), np.float32)
        return Model(np.zeros((TERMS, 1), np.float32), np.zeros(1, np.float32), nothing, nothing[:, 0], 1.0)
    targets = np.concatenate(known)[:, 0].astype(np.float64)
    many = len(targets)
    held, sums = np.sum([b.astype(np.float64) for b in blocks], axis=0)
    idf = (np.log((1 + many) / (1 + held)) + 1).astype(np.float32)
    mean = (sums / many * idf).astype(np.float32)
    basis = np.random.default_rng(7).standard_normal((TERMS, rank + 8)).astype(np.float32)
    for _ in range(3):
        shared = context.broadcast(idf[:, None] * basis)
        parts = _over(sample, lambda rows, label, b=shared: rows.T @ (rows @ b.value))
        grown = idf[:, None] * np.sum(parts, axis=0, dtype=np.float64) - many * np.outer(mean, mean @ basis)
        basis = np.linalg.qr(grown)[0].astype(np.float32)
        shared.unpersist()
    shared = context.broadcast(idf[:, None] * basis)
    latent = np.concatenate(_over(sample, lambda rows, label: rows @ shared.value)) - mean @ basis
    _, size, right = np.linalg.svd(latent, full_matrices=False)
    # Directions in which the sample does not differ say nothing of other texts.
    turned = right[:rank][size[:rank] > 1e-4 * max(size[0], 1e-6)].T
    projection = basis @ turned
    return Model(idf[:, None] * projection, mean @ projection, _unit(latent @ turned), targets, float(targets.mean()))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_score``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = Model(*shared.value)
        for batch in batches:
            for part in chunks(batch):
                text = part.column("text").cast(pa.binary())
                score = np.concatenate([vote(model, rows) for rows in _rows(text)])
                yield {n: part.column(n) for n in part.schema.names} | {"_score": pa.array(score, pa.float64())}

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    found = scored(docs.select("doc_id", "text"), train(docs, labels))
    predicted = F.when(F.col("_score") >= THRESHOLD, 1).otherwise(0)
    return found.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), predicted.alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score of at least the threshold, with all columns."""
    return scored(docs, train(docs, labels)).filter(F.col("_score") >= THRESHOLD).select(*docs.columns)
