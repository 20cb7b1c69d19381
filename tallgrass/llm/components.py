"""Connected components of links between rows of any number of tasks.

Large-star and small-star steps in turn: every step points nodes to the smallest
neighbour. A node's neighbours are never gathered, only their minimum is, which
combines before the shuffle. Each round is written to the shared folder, so a
lost executor costs one round at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tallgrass.llm.common import stored

MAX_ROUNDS = 60


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links ``a - b`` as links from every node to the smallest of its component; never more than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while not np.array_equal(deeper := new[new], new):
            new = deeper
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _step(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))
    both = edges.select(F.explode(ends).alias("e")).select("e.a", "e.b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lowest, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return small.select("e.u", "e.v").filter("u > v").distinct()


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20)))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u``, ``v`` longs) that is not its component's smallest."""
    links = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = stored(links, "links")
    before = _print_of(links)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        links = stored(_step(links), "links")
        after = _print_of(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
