"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints that differ in at most 3 of 64 bits differ in at most 1 bit of one
of the two halves. For each half the code words of the [31, 26] Hamming code on
31 of its bits are the anchors: every point lies within 1 of exactly one, its
home. A fingerprint visits every anchor within covering radius plus threshold,
1 + 1 = 2 bits: 1 or 16 per half. So each link shows where one end is at home.
Per anchor, homes are compared with visitors, and the links found leave as stars,
at most one per visitor. An anchor that has many rows is cut: its homes and its
visitors are dealt into blocks by a hash, and each pair of blocks is a piece of
work of its own. Tasks read their pieces one after the other.

Defined cases: a null or empty text has no words and fingerprint 0, which links
like any other. Rows that repeat a ``doc_id`` are linked by their texts. Equal
fingerprints are one point. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tallgrass.llm.common import map_batches, stored, text_key, without_repeats
from tallgrass.llm.components import components, local_stars
from tallgrass.operators.skew import hottest, lookup_join

SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Pairs that one step compares, and links kept before they become stars.
PAIRS = 1 << 21
#: Homes in a block of an anchor (twice as many visitors), anchors that can be cut, and the share of nodes that tells them.
HOMES = 2048
HOT_ANCHORS = 1 << 16
SEEN = 8
#: Rows that a task takes at once, whole pieces.
ROWS = 1 << 17
_MASK31 = (1 << 31) - 1


def shingle_hashes(text: bytes, words: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased text, repeats included."""
    parts = text.lower().split()  # bytes: A-Z only, and white space 0x20, 0x09-0x0D
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    many = max(len(parts) - words + 1, 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:many].tolist(), ends[min(words, len(parts)) - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (a signed long), and ``_key`` of the text."""

    def run(batches):
        for batch in batches:
            found = [_signed(fingerprint(shingle_hashes(t or b"", words))) for t in batch.column("_text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "_key": batch.column("_key"), "fp": pa.array(found, pa.int64())}

    rows = docs.select("doc_id", text_key().alias("_key"), F.col("text").cast("binary").alias("_text"))
    return map_batches(rows, run, "doc_id long, _key long, fp long")


def _syndrome(x: np.ndarray) -> np.ndarray:
    found = np.zeros(len(x), np.int64)
    for bit in range(1, 32):
        found ^= np.where(x >> (bit - 1) & 1, bit, 0)
    return found


def anchors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 31-bit points: index of the point, anchor, and whether it is the point's home."""
    syndrome = _syndrome(x)
    flip = np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)
    index, anchor = [np.arange(len(x))], [x ^ flip]
    off = np.flatnonzero(syndrome)
    for i in range(1, 32):  # code words at distance 2: bits i < j with i xor j the syndrome
        j = i ^ syndrome[off]
        rows = off[j > i]
        index.append(rows)
        anchor.append(x[rows] ^ (1 << (i - 1)) ^ (1 << (j[j > i] - 1)))
    home = np.arange(sum(map(len, index))) < len(x)
    return np.concatenate(index), np.concatenate(anchor), home


def _visits(batches):
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        for half in (0, 1):
            index, anchor, home = anchors((fp >> (32 * half)) & _MASK31)
            # The half is part of the anchor's number; a home is marked by the lowest bit.
            yield {"anchor": pa.array(anchor << 1 | half), "fp": pa.array(fp[index]), "home": pa.array(home)}


def near_pairs(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of homes and visitors of one anchor with near fingerprints, ``PAIRS`` comparisons at a time."""
    order = np.argsort(anchor, kind="stable")
    anchor, fp, home = anchor[order], fp[order], home[order]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(anchor)))
    group = np.repeat(np.arange(len(first)), size)
    hosts = np.flatnonzero(home & (size[group] > 1))
    work = np.cumsum(size[group[hosts]]) if len(hosts) else np.zeros(0, np.int64)
    at = 0
    while at < len(hosts):
        done = work[at - 1] if at else 0
        end = max(int(np.searchsorted(work, done + PAIRS, "right")), at + 1)
        some = hosts[at:end]
        many = size[group[some]]
        left = np.repeat(some, many)
        right = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[group[some]], many)
        near = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= distance
        yield order[left[near]], order[right[near]]
        at = end


def links_in(
    anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, node: np.ndarray, distance: int, alike: Callable | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Stars over the nodes that are linked inside each anchor. ``alike`` may turn down pairs of positions."""
    stars = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    kept = 0
    for left, right in near_pairs(anchor, fp, home, distance):
        good = node[left] != node[right]
        left, right = left[good], right[good]
        if alike:
            good = alike(left, right)
            left, right = left[good], right[good]
        stars[0].append(node[left])
        stars[1].append(node[right])
        kept += len(left)
        if kept > PAIRS:
            a, b = local_stars(np.concatenate(stars[0]), np.concatenate(stars[1]))
            stars, kept = ([a], [b]), len(a)
    a, b = np.concatenate(stars[0]), np.concatenate(stars[1])
    return local_stars(a, b) if len(a) else (a, b)


def hot_anchors(nodes: DataFrame, visit: Callable, schema: str, node: str) -> DataFrame:
    """``anchor, _hosts, _guests``: into how many blocks the homes and the visitors of crowded anchors are cut.

    Every ``SEEN``-th node by a hash is counted, which sets the size of blocks and no result.
    An anchor beyond the ``HOT_ANCHORS`` largest has at most 1/``HOT_ANCHORS`` of all visits.
    """
    some = nodes.filter(F.pmod(F.xxhash64(F.lit(3), node), F.lit(SEEN)) == 0)
    counts = map_batches(some, visit, schema) if visit else some
    counts = counts.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("home").cast("long")).alias("_homes"))
    large = hottest(counts.filter(F.col("_n") * SEEN > HOMES), "anchor", "_n", HOT_ANCHORS)
    blocks = lambda n, size: F.greatest(F.ceil(F.col(n) * SEEN / size), F.lit(1)).cast("long").alias
    return large.select("anchor", blocks("_homes", HOMES)("_hosts"), blocks("_n", 2 * HOMES)("_guests"))


def pieces(visits: DataFrame, hot: DataFrame, node: str) -> DataFrame:
    """Rows dealt and sorted by piece (``anchor, _h, _g``), with their part in it (``host``).

    In an anchor that is not cut, homes are hosts and guests in one row. In others a
    row is a guest in its own guest block, beside every block of hosts, and a home
    also a host in its host block, beside every block of guests.
    """
    rows = visits.join(F.broadcast(hot), "anchor", "left")
    spread = F.xxhash64(F.lit(4), node)
    place = lambda h, g, host: F.struct(h.alias("h"), g.alias("g"), host.alias("host"))
    many = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    zero = F.lit(0).cast("long")
    guests = F.transform(many("_hosts"), lambda h: place(h, F.pmod(spread, F.col("_guests")), F.lit(False)))
    hosts = F.transform(many("_guests"), lambda g: place(F.pmod(spread, F.col("_hosts")), g, F.lit(True)))
    cut = F.when(F.col("home"), F.concat(hosts, guests)).otherwise(guests)
    cold = rows.filter("_hosts is null").select(*visits.columns, zero.alias("_h"), zero.alias("_g"), F.col("home").alias("host"), F.lit(False).alias("cut"))
    dealt = rows.filter("_hosts is not null").withColumn("_p", F.explode(cut))
    dealt = dealt.select(*visits.columns, F.col("_p.h").alias("_h"), F.col("_p.g").alias("_g"), F.col("_p.host").alias("host"), F.lit(True).alias("cut"))
    return cold.unionByName(dealt).repartition("anchor", "_h", "_g").sortWithinPartitions("anchor", "_h", "_g")


def whole_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of at least ``ROWS`` rows made of whole pieces, and the number of each row's piece."""

    def numbered(table):
        keys = np.stack([table.column(n).to_numpy() for n in ("anchor", "_h", "_g")])
        return np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])

    held, many = [], 0
    for batch in batches:
        held.append(batch)
        many += len(batch)
        if many >= ROWS:
            table = pa.Table.from_batches(held)
            piece = numbered(table)
            end = int(np.searchsorted(piece, piece[-1]))
            if end:
                yield table.slice(0, end), piece[:end]
            held = table.slice(end).combine_chunks().to_batches()
            many = 0 if end else len(table)  # what is left over is one piece, of bounded size
    if held:
        table = pa.Table.from_batches(held)
        yield table, numbered(table)


def links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``u, v`` that join the distinct fingerprints ``fp`` as the full set of links would."""
    if distance > 3:
        raise ValueError("the anchors cover distances up to 3")

    def compare(batches):
        for rows, piece in whole_pieces(batches):
            fp = rows.column("fp").to_numpy()
            u, v = links_in(piece, fp, rows.column("host").to_numpy(), fp, distance)
            yield {"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())}

    schema = "anchor long, fp long, home boolean"
    visits = map_batches(points, _visits, schema)
    return map_batches(pieces(visits, hot_anchors(points, _visits, schema, "fp"), "fp"), compare, "u long, v long")


def near_duplicates(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``, with ``_key``."""
    prints = stored(fingerprints(docs, words), "simhash")
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("_low"), F.count(F.lit(1)).alias("_rows")), "points")
    roots = components(links(points.select("fp"), distance))
    placed = points.join(roots, points["fp"] == roots["node"], "left").withColumn("_root", F.coalesce("root", "fp"))
    lowest = placed.groupBy("_root").agg(F.min("_low").alias("component_id"))
    known = placed.select("fp", "_root", "_rows").join(lowest, "_root").select("fp", "component_id", "_rows", "_root")
    found = lookup_join(prints, known, "fp", "_rows", ["doc_id", "_key"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "_key", "_root")


def keep_one(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of linked fingerprints, the one with the smallest ``doc_id``.

    A null id stays only where its group has no other. Of rows that repeat id and text one stays.
    """
    found = near_duplicates(docs, words, distance).withColumn("_id", _order_of("doc_id"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "_id", "_key"))
    stay = found.groupBy("_root").agg(least.alias("s")).select("s._key", "s._id")
    rows = without_repeats(docs.withColumns({"_key": text_key(), "_id": _order_of("doc_id")}), ["_key", "_id"])
    # Join and numbering have the same keys: whole rows move once.
    nth = F.row_number().over(Window.partitionBy("_key", "_id").orderBy("_key"))
    kept = rows.join(stay, ["_key", "_id"]).withColumn("_nth", nth)
    return kept.filter("_nth = 1").select(*docs.columns)


def _order_of(column: str):
    return F.coalesce(column, F.lit(-(1 << 63)).cast("long"))
