"""A Merkle tree over a dataset: trees of the rows of each source under a tree of the sources.

Every level is one table ``tree, index, total, digest``. A node's siblings are found by
equality joins of the level with itself: the indices of the others in its run of
``ARITY`` nodes are computed from its slot (slot 0 looks 1 and 2 ahead, slot 1 one back
and one ahead, slot 2 two and one back). Then the rows in slot zero emit the parents.
No run is ever gathered, and no key has more than one row, so a source of any size
weighs no more than its rows. The levels are stored, each a third of the one below;
proofs then go down from the root by joins of a level with the one above it.

Digests are SHA-256 of hexadecimal digests, in lower case; tables hold their bytes.

Defined cases: a null field is hashed as ``-``, other fields as their count of UTF-8
bytes, ``:`` and value. Null sources come first, as a source of their own; null ids come
first in their source; rows that repeat an id are ordered by their leaf, equal rows have
equal leaves, each with a proof of its own. A row without an id is not tampered with. An
empty table gives an empty table. Other columns do not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.llm.common import stored
from tallgrass.operators.numbering import numbered

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = ("tree", "index", "total", "digest")


def digest_of(*parts: Column) -> Column:
    """Bytes of the digest of some digests, concatenated as hexadecimal text."""
    return F.unhex(F.sha2(F.lower(F.hex(F.concat(*parts))), 256))


def leaf_of(*fields: Column) -> Column:
    """Bytes of the digest of the fields of a row."""
    sized = [F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")) for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(s, F.lit("-")) for s in sized]), 256))


def _beside(nodes: DataFrame) -> DataFrame:
    """Nodes with ``left`` and ``right``, the digests of the others of their run before and after them."""
    slot = F.col("index") % ARITY
    first = F.col("index") + F.when(slot == 0, 1).otherwise(-slot)
    second = F.col("index") + F.when(slot == 2, -1).otherwise(2 - slot)
    at = nodes.withColumns({"_first": first, "_second": second})
    for name in ("_first", "_second"):
        other = nodes.select("tree", F.col("index").alias(name), F.col("digest").alias(f"{name}_digest"))
        at = at.join(other, ["tree", name], "left")
    nothing = F.lit(b"")
    one, two = (F.coalesce(f"{n}_digest", nothing) for n in ("_first", "_second"))
    left = F.when(slot == 0, nothing).when(slot == 1, one).otherwise(F.concat(one, two))
    right = F.when(slot == 0, F.concat(one, two)).when(slot == 1, two).otherwise(nothing)
    return at.select(*nodes.columns, left.alias("left"), right.alias("right"))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels of all trees, each with the siblings of its nodes, and the tops that each level adds.

    ``nodes`` are the leaves, numbered from 0 in their tree. A tree of one leaf is its own top.
    """
    height, most = 0, nodes.agg(F.max("total")).first()[0] or 1
    while most > 1:
        height, most = height + 1, -(-most // ARITY)
    levels, tops = [], [nodes.filter("total = 1").select(*_NODE)]
    for _ in range(height):
        level = stored(_beside(nodes.filter("total > 1")), "merkle")
        up = F.col("index") % ARITY == 0
        nodes = level.filter(up).select(
            "tree",
            F.floor(F.col("index") / ARITY).alias("index"),
            F.ceil(F.col("total") / ARITY).alias("total"),
            digest_of(F.col("left"), F.col("digest"), F.col("right")).alias("digest"),
        )
        levels.append(level)
        tops.append(nodes.filter("total = 1"))
    return levels, tops


def descend(levels: list[DataFrame], tops: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """Leaves with what their ``tops`` carry below ``proof`` and ``subroot``, the own path put before it.

    ``proof`` is an array of ``left`` and ``right``, the siblings of each level upwards.
    """
    above = tops[-1]
    for level, top in zip(reversed(levels), reversed(tops[:-1])):
        parent = above.select("tree", F.col("index").alias("_parent"), F.col("proof").alias("_up"), "subroot")
        step = F.array(F.struct("left", "right"))
        found = level.withColumn("_parent", F.floor(F.col("index") / ARITY)).join(parent, ["tree", "_parent"])
        found = found.withColumn("proof", F.concat(step, "_up")).drop("_up", "_parent", "left", "right")
        above = found.unionByName(top, allowMissingColumns=True) if level is not levels[0] else found
    if not levels:
        return leaves.join(tops[0].select("tree", "proof", "subroot"), "tree")
    alone = leaves.filter("total = 1").join(tops[0].select("tree", "proof", "subroot"), "tree")
    return above.unionByName(alone)


def folded(proof: Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(proof, leaf, lambda node, step: digest_of(step["left"], node, step["right"]))


def _sources(tops: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Per source its subroot and the proof from there to the root, and the root as a one-row table."""
    roots = tops[0]
    for top in tops[1:]:
        roots = roots.unionByName(top)
    ranked = numbered(roots.select(F.col("tree").alias("source_key"), "digest"), ["source_key"])
    leaves = stored(
        ranked.select("source_key", F.lit(0).alias("tree"), F.col("_index").alias("index"), F.col("_total").alias("total"), "digest"), "subroots"
    )
    levels, ends = climb(leaves)
    path = F.array().cast("array<struct<left:binary,right:binary>>").alias("proof")
    known = descend(levels, [e.select(*_NODE, path, F.lit(None).cast("binary").alias("subroot")) for e in ends], leaves)
    return known.select(F.col("source_key").alias("tree"), "proof", F.col("digest").alias("subroot")), ends[-1].select("digest")


def manifest(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, leaf, subroot, root, proof`` and ``proof_sha256, folded_root, verified``.

    What is folded is the row as it would arrive: of the ids whose checksum is even, the
    text has lost its line breaks.
    """
    fields = [F.col(f) for f in FIELDS]
    broken = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    leaf = leaf_of(*fields)
    arrived = F.when(broken & F.contains("text", F.lit("\n")), leaf_of(*fields[:-1], F.translate("text", "\n", ""))).otherwise(leaf)
    tree = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("tree")
    hashed = stored(docs.select(tree, "doc_id", leaf.alias("digest"), arrived.alias("arrived")), "leaves")
    leaves = numbered(hashed, ["doc_id", "digest"], ["tree"])
    leaves = stored(leaves.withColumnsRenamed({"_index": "index", "_total": "total"}), "leaves")
    levels, tops = climb(leaves)
    sources, root = _sources(tops)
    sources = stored(sources, "sources")
    ends = [t.join(sources, "tree") for t in tops]
    known = descend(levels, ends, leaves).select(*leaves.columns, "proof", "subroot")
    siblings = F.transform("proof", lambda step: F.concat(step["left"], step["right"]))
    joined = F.aggregate(siblings, F.lit("").cast("string"), lambda text, s: F.concat(text, F.lower(F.hex(s))))
    text = lambda c: F.lower(F.hex(c))
    found = known.select(
        "doc_id", text("digest").alias("leaf"), text("subroot").alias("subroot"), text(root.scalar()).alias("root"),
        F.sha2(joined, 256).alias("proof_sha256"), text(folded(F.col("proof"), F.col("arrived"))).alias("folded_root"), "proof",
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
