"""Near-duplicate vectors by collision counting over one-dimensional projections.

Vectors of one label and length are projected to ``PROJECTIONS`` random lines.
Two unit vectors with cosine ``least`` lie at a distance d = sqrt(2 - 2 least), so
their projections differ by a normal deviate of size d. A vector's window on a
line reaches ``REACH * d`` to both sides; pairs that fall into each other's
windows at least ``COUNT`` times are verified by cosine in double precision.
``COUNT`` is calibrated: a pair right at the threshold passes with probability
``RECALL`` or more, pairs above it with more.

The first line, with a window wide enough for any such pair (``WIDE * d``), is
sorted into cells as wide as that window: a vector is at home in one cell and a
guest in it and both its neighbours. Homes and guests of a cell are cut into
blocks of about ``BLOCK`` rows, and each pair of blocks is one bounded piece of
work, sorted along the line so that windows are slices. Only sums per vector and
stars of the links leave a piece, never pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without label, link with nothing and are kept. Equal vectors
of one label are one point; their rows link with each other. Vectors of different
lengths never link. A null ``vec_id`` counts as a row, but names no component
unless all rows of it are null. Empty tables give empty tables.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallgrass.llm.common import importable, map_batches, same, stored
from tallgrass.llm.components import components, local_stars
from tallgrass.operators.skew import lookup_join

LEAST = 0.98
PROJECTIONS = 16
REACH = 2.0
WIDE = 4.0
RECALL = 0.9999
BLOCK = 2048
_SEED = 20
_STRIDE = 256


def needed_count(projections: int = PROJECTIONS, reach: float = REACH, recall: float = RECALL) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall``."""
    p = math.erf(reach / math.sqrt(2))
    reached, count = 0.0, projections + 1
    while reached < recall:
        count -= 1
        reached += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
    return count


def lines(length: int) -> np.ndarray:
    """The same random directions in every task: one column each."""
    return np.random.default_rng([_SEED, length]).standard_normal((length, PROJECTIONS))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def points(vectors: DataFrame) -> DataFrame:
    """Rows with their class: ``vec_id, _class`` (null for rows that never link), ``label, embedding``."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (F.size("embedding") > 0) & F.col("label").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    key = F.concat_ws("-", F.hex(F.xxhash64("embedding")), F.hex(F.xxhash64(F.lit(1), "embedding")), F.col("label").cast("string"))
    return vectors.select("vec_id", F.when(F.coalesce(usable, F.lit(False)), key).alias("_class"), "label", "embedding")


def _first_line(least: float):
    width = WIDE * math.sqrt(2 - 2 * least)

    def run(batches):
        for batch in batches:
            sizes = batch.column("_length").to_numpy()
            cell = np.zeros(len(batch), np.int64)
            for length in np.unique(sizes):
                rows = np.flatnonzero(sizes == length)
                x = _unit(_matrix(batch.column("embedding").take(pa.array(rows))))
                cell[rows] = np.floor(x @ lines(int(length))[:, 0] / width)
            yield {n: batch.column(n) for n in batch.schema.names} | {"cell": pa.array(cell)}

    return run


def _blocks(placed: DataFrame) -> DataFrame:
    """Rows copied to the pieces of work in which they are home or guest."""
    cells = placed.groupBy("label", "_length", "cell").agg(F.count(F.lit(1)).alias("_n"))
    around = cells.select("label", "_length", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"), "_n")
    guests = around.groupBy("label", "_length", "cell").agg(F.sum("_n").alias("_g"))
    cuts = cells.join(guests, ["label", "_length", "cell"]).select(
        "label", "_length", "cell", F.ceil(F.col("_n") / BLOCK).alias("_hb"), F.ceil(F.col("_g") / (2 * BLOCK)).alias("_gb")
    )
    spread = F.xxhash64("_node")
    homes = placed.withColumn("home", F.lit(True))
    visits = placed.withColumn("cell", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1))).withColumn("home", F.lit(False))
    rows = homes.unionByName(visits).join(cuts, ["label", "_length", "cell"])
    h = F.when(F.col("home"), F.array(F.pmod(spread, F.col("_hb")))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("_hb") - 1))
    g = F.when(F.col("home"), F.sequence(F.lit(0).cast("long"), F.col("_gb") - 1)).otherwise(F.array(F.pmod(spread, F.col("_gb"))))
    rows = rows.withColumn("_h", F.explode(h)).withColumn("_g", F.explode(g))
    return rows.select("label", "_length", "cell", "_h", "_g", "home", "_node", "_rows", "embedding")


def close_pairs(homes: np.ndarray, guests: np.ndarray, least: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows whose cosine is ``least`` or more, among those that collide ``count`` times."""
    d = math.sqrt(2 - 2 * least)
    directions = lines(homes.shape[1])
    a, b = (_unit(homes) @ directions).astype(np.float32), (_unit(guests) @ directions).astype(np.float32)
    by_a, by_b = np.argsort(a[:, 0], kind="stable"), np.argsort(b[:, 0], kind="stable")
    a, b = a[by_a], b[by_b]
    norm_a, norm_b = np.linalg.norm(homes, axis=1), np.linalg.norm(guests, axis=1)
    left, right = [], []
    for at in range(0, len(a), _STRIDE):
        some = a[at : at + _STRIDE]
        low = np.searchsorted(b[:, 0], some[0, 0] - WIDE * d, "left")
        high = np.searchsorted(b[:, 0], some[-1, 0] + WIDE * d, "right")
        hits = np.zeros((len(some), high - low), np.uint8)
        for line in range(directions.shape[1]):
            hits += np.abs(some[:, line, None] - b[None, low:high, line]) <= REACH * d
        i, j = np.nonzero(hits >= count)
        i, j = by_a[i + at], by_b[j + low]
        cosine = np.einsum("ij,ij->i", homes[i], guests[j]) / (norm_a[i] * norm_b[j])
        left.append(i[cosine >= least])
        right.append(j[cosine >= least])
    return np.concatenate(left), np.concatenate(right)


def _work(least: float, count: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        home = rows.column("home").to_numpy()
        node = rows.column("_node").to_numpy()
        weight = rows.column("_rows").to_numpy()
        x = _matrix(rows.column("embedding").combine_chunks())
        hosts, guests = np.flatnonzero(home), np.flatnonzero(~home)
        u = v = n = np.zeros(0, np.int64)
        if len(hosts) and len(guests):
            i, j = close_pairs(x[hosts], x[guests], least, count)
            i, j = hosts[i], guests[j]
            other = node[i] != node[j]
            i, j = i[other], j[other]
            n = np.bincount(i, weights=weight[j], minlength=len(rows)).astype(np.int64)
            got = np.flatnonzero(n)
            u, v = local_stars(node[i], node[j]) if len(i) else (node[:0], node[:0])
            # Counts are rows without a second end.
            return _result(np.concatenate([u, node[got]]), np.concatenate([v, node[got]]), np.concatenate([np.zeros(len(u), np.int64), n[got]]))
        return _result(u, v, n)

    return run


def _result(u, v, n) -> pa.Table:
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "n": pa.array(n, pa.int64())})


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``."""
    importable(vectors.sparkSession)
    rows = points(vectors)
    classes = rows.filter("_class is not null").groupBy("_class").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"),
        F.min("vec_id").alias("_low"), F.count(F.lit(1)).alias("_rows"),
    )
    # Numbered once and written, so that the numbers stay.
    classes = stored(classes.withColumn("_node", F.monotonically_increasing_id()), "classes")
    placed = map_batches(
        classes.select("label", F.size("embedding").alias("_length"), "embedding", "_node", "_rows"), _first_line(least),
        "label int, _length int, embedding array<float>, _node long, _rows long, cell long",
    )
    pieces = _blocks(placed).groupBy("label", "_length", "cell", "_h", "_g")
    found = stored(pieces.applyInArrow(_work(least, needed_count()), "u long, v long, n long"), "near")
    counts = found.filter("u = v").groupBy(F.col("u").alias("_node")).agg(F.sum("n").alias("_links"))
    roots = components(found.filter("u <> v").select("u", "v"))
    known = classes.select("_class", "_node", "_low", "_rows").join(counts, "_node", "left")
    known = known.join(roots.withColumnsRenamed({"node": "_node"}), "_node", "left").withColumn("_root", F.coalesce("root", "_node"))
    lowest = known.groupBy("_root").agg(F.min("_low").alias("_component"))
    known = known.join(lowest, "_root").select("_class", "_component", (F.coalesce("_links", F.lit(0)) + F.col("_rows") - 1).alias("_links"), "_rows")
    joined = lookup_join(rows.select("vec_id", "_class"), known, "_class", "_rows", ["vec_id"])
    component = F.when(F.col("_class").isNull(), F.col("vec_id")).otherwise(F.col("_component"))
    return joined.select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        same(F.col("vec_id"), component).alias("kept"),
    )
