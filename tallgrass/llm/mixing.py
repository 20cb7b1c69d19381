"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words. Sources by code point, null last, weigh ``weights`` in turn;
together they get ``share`` of all words, none more than twice its own size: the
excess goes to the others by weight. The words of a source, its documents in
shuffled order, form blocks of ``block`` words. Golden-ratio points through the
cumulative slot shares name the source of each slot of the mix; the n-th slot
of a source takes its n-th block, round and round. The last block is cut so
that a source gives exactly its rounded target.

Nulls and ties: a null text has size 0 and is never taken; a null source is a
source of its own; repeated rows count as often as they occur. Empty tables
give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallgrass.llm.common import text_key

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 1024
#: Hash parts of a source that are summed apart, so that no task sorts a whole source.
PART_DIGITS = 3
#: Slots of a source are ranked inside runs of so many.
RUN = 1 << 16
_BITS = 31
_GOLDEN = 1327217885  # 2**31 times the fractional golden ratio; odd, so no point repeats
_CELL_BITS = 12


def word_count(text: str | Column = "text") -> Column:
    counted = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++"))
    return F.coalesce(counted, F.lit(0)).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    digest = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit(""))
    return docs.select(
        "doc_id",
        text_key().alias("_key"),
        word_count().alias("size"),
        # one non-null key that sorts null last
        F.coalesce(F.concat(F.lit("a"), "source"), F.lit("b")).alias("_s"),
        digest.alias("_order"),
        F.substring(digest, 1, PART_DIGITS).alias("_part"),
    )


def targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per source: ``_s, source_size, target``."""
    sizes = _sized(docs).groupBy("_s").agg(F.sum("size").alias("source_size"))
    return _targets(sizes, weights, share)


def _targets(sizes: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """Sources in the order in which they fill up: the level ``_level`` per unit of
    weight that is left when those before are full. The largest is the final one."""
    rank = F.row_number().over(Window.orderBy("_s"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    every = Window.partitionBy()
    filling = Window.orderBy(F.col("_cap") / F.col("_w"), "_s")
    ranked = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(MOST))
    level = (F.sum("source_size").over(every) * share - F.sum("_cap").over(filling) + F.col("_cap")) / (
        F.sum("_w").over(every) - F.sum("_w").over(filling) + F.col("_w")
    )
    return (
        ranked.withColumn("_level", level)
        .withColumn("target", F.least("_cap", F.max("_level").over(every) * F.col("_w")))
        .select("_s", "source_size", "target")
    )


def _plans(sources: DataFrame, block: int) -> DataFrame:
    """Per source: words to take, blocks, slots, and its interval of the schedule."""
    planned = sources.filter("source_size > 0").select(
        "_s",
        "source_size",
        F.least(F.round("target").cast("long"), F.col("source_size") * MOST).alias("_take"),
        F.ceil(F.col("source_size") / block).cast("long").alias("_blocks"),
    )
    rest = F.col("_take") % F.col("source_size")
    planned = planned.withColumn("_rest", rest).withColumn(
        "_slots", F.floor(F.col("_take") / F.col("source_size")) * F.col("_blocks") + F.ceil(rest / block)
    )
    whole, upto = F.sum("_slots").over(Window.partitionBy()), F.sum("_slots").over(Window.orderBy("_s"))
    scale = float(1 << _BITS)
    return planned.withColumns({
        "_all": whole,
        "_low": F.floor((upto - F.col("_slots")) / whole * scale),
        "_high": F.floor(upto / whole * scale),
    })


def schedule(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """The mix as slots: ``slot`` (its place), ``_s``, ``rank``, ``block`` (of the source), ``words`` taken from it."""
    return _schedule(_plans(targets(docs, weights, share), block), block)


def _schedule(plans: DataFrame, block: int) -> DataFrame:
    cells = plans.withColumn(
        "_cell",
        F.explode(F.sequence(F.shiftright("_low", _BITS - _CELL_BITS), F.shiftright(F.greatest(F.col("_high") - 1, F.col("_low")), _BITS - _CELL_BITS))),
    )
    slots = plans.agg(F.coalesce(F.max("_all"), F.lit(0)).alias("_all"))
    # As many points as slots: runs of slots, each made out by its own task.
    runs = slots.select(F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_all") / RUN))).alias("_run"), "_all")
    points = (
        runs.repartition("_run")
        .select("_run", "_all", F.explode(F.sequence(F.col("_run") * RUN, (F.col("_run") + 1) * RUN - 1)).alias("_i"))
        .filter(F.col("_i") < F.col("_all"))
        .withColumn("_point", F.pmod(F.pmod("_i", F.lit(1 << _BITS)) * _GOLDEN, F.lit(1 << _BITS)))
        .withColumn("_cell", F.shiftright("_point", _BITS - _CELL_BITS))
        .drop("_all")
    )
    hits = points.join(cells, "_cell").filter("_point >= _low and _point < _high").select("_s", "_run", "_i")
    counts = hits.groupBy("_s", "_run").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_s").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("_s", "_run").orderBy("_i")
    ranked = (
        hits.withColumn("_nth", F.row_number().over(inside))
        .join(firsts.select("_s", "_run", "_first"), ["_s", "_run"])
        .select("_s", F.col("_i").alias("slot"), (F.col("_first") + F.col("_nth") - 1).alias("rank"))
    )
    # Points miss a source by a few slots at most: spare ones go, missing ones follow at the end.
    scheduled = counts.groupBy("_s").agg(F.sum("_n").alias("_n"))
    missing = (
        plans.join(scheduled, "_s", "left")
        .withColumn("_n", F.coalesce("_n", F.lit(0)))
        .filter("_n < _slots")
        .select("_s", F.col("_all").alias("slot"), F.explode(F.sequence(F.col("_n"), F.col("_slots") - 1)).alias("rank"))
    )
    placed = ranked.unionByName(missing).join(plans, "_s").filter("rank < _slots")
    number = F.col("rank") % F.col("_blocks")
    last_round = F.floor(F.col("rank") / F.col("_blocks")) == F.floor(F.col("_take") / F.col("source_size"))
    left = F.when(last_round, F.col("_rest")).otherwise(F.col("source_size")) - number * block
    return placed.select("slot", "_s", "rank", number.alias("block"), F.least(left, F.lit(block)).alias("words"))


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per row of ``docs``, and its ``source``."""
    rows = _sized(docs)
    parts = rows.groupBy("_s", "_part").agg(F.sum("size").alias("_words"))
    sources = _targets(parts.groupBy("_s").agg(F.sum("_words").alias("source_size")), weights, share)
    earlier = Window.partitionBy("_s").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = parts.select("_s", "_part", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_s", "_part").orderBy("_order", "doc_id", "size", "_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("_upto", F.sum("size").over(inside))
        .join(firsts, ["_s", "_part"])
        .withColumn("_end", F.col("_first") + F.col("_upto"))
        .withColumn("_start", F.col("_end") - F.col("size"))
        .select("doc_id", "_key", "size", "_s", "_start", "_end")
    )
    # A block is taken whole several times, or cut: words times how often.
    used = (
        _schedule(_plans(sources, block), block)
        .groupBy("_s", "block", "words")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    touched = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block)))
    pieces = placed.withColumn("block", F.explode_outer(touched)).join(used, ["_s", "block"], "left")
    overlap = F.least("_end", F.col("block") * block + F.col("words")) - F.greatest("_start", F.col("block") * block)
    words = F.coalesce(F.greatest(overlap, F.lit(0)) * F.col("_times"), F.lit(0))
    # A row with words has a start of its own in its source. Rows without words stay apart by their count.
    got = pieces.groupBy("doc_id", "_key", "size", "_s", "_start").agg(
        F.sum(words).alias("taken"), F.count(F.when(F.col("size") == 0, 1)).alias("_empty")
    )
    every = got.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(F.col("_empty"), F.lit(1))))).drop("_copy")
    return every.join(sources, "_s").select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"),
        F.when(F.col("_s") != "b", F.substring("_s", 2, 1 << 30)).alias("source"), "_key",
    )


def repeated(docs: DataFrame) -> DataFrame:
    """The mix: each row of ``docs`` as often as its words are taken, a begun copy whole; none if none are."""
    identity = [F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("_id"), F.col("_key"), F.coalesce(F.concat(F.lit("a"), "source"), F.lit("b")).alias("_s")]
    got = taken(docs).filter("taken > 0").select(*identity, F.ceil(F.col("taken") / F.col("size")).alias("_times"))
    got = got.groupBy("_id", "_key", "_s").agg(F.sum("_times").alias("_times"))
    keyed = docs.withColumn("_key", text_key()).select("*", identity[0], identity[2])
    # Rows that repeat each other share their copies evenly. Join and numbering have the
    # same keys: whole rows move once.
    same = Window.partitionBy("_id", "_key", "_s")
    joined = keyed.join(got, ["_id", "_key", "_s"]).withColumn("_turn", F.row_number().over(same.orderBy("_key")))
    joined = joined.withColumn("_rows", F.max("_turn").over(same))
    times = F.floor(F.col("_times") / F.col("_rows")) + F.when(F.col("_turn") <= F.col("_times") % F.col("_rows"), 1).otherwise(0)
    copies = joined.withColumn("_copies", F.when(times > 0, F.sequence(F.lit(1).cast("long"), times)))
    return copies.withColumn("_copy", F.explode("_copies")).select(*docs.columns)
