"""Word co-occurrence (PMI) and bigram statistics over lines of text.

A line is a row with a ``value`` column. Functions that start from
``tokenized`` take the result of :func:`tokenized_lines`.

Words co-occur inside a stretch: lines are cut into consecutive stretches of
``max_words`` tokens, so every token takes part and a stretch has a bounded
number of pairs. A line of up to ``max_words`` tokens is one stretch.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.functions import stats
from tallgrass.functions.tokens import (
    DEFAULT_THRESHOLD,
    MARGINAL_MARK,
    MAX_WORDS_PER_LINE,
    explode_once,
    stretch_count,
    stretches,
    tokenize,
)
from tallgrass.operators import bigrams
from tallgrass.operators.paircells import COUNTS, cell_counts
from tallgrass.session import new_run_dir

STRIPE_ENTRIES = 10_000


def tokenized_lines(lines: DataFrame, letters: str = "a-z") -> DataFrame:
    """Replace ``value`` by ``tokens``; blank lines stay, with an empty array."""
    keep = [c for c in lines.columns if c != "value"]
    return lines.select(*keep, tokenize("value", letters).alias("tokens"))


def line_count(tokenized: DataFrame) -> DataFrame:
    return tokenized.agg(F.count(F.lit(1)).alias("n_lines"))


def _stretches(tokenized: DataFrame, max_words: int) -> DataFrame:
    return explode_once(tokenized, stretches("tokens", max_words), "words")


def stretch_total(tokenized: DataFrame, max_words: int = MAX_WORDS_PER_LINE) -> DataFrame:
    return tokenized.agg(F.sum(stretch_count("tokens", max_words)).alias("n_stretches"))


def word_line_counts(tokenized: DataFrame, max_words: int = MAX_WORDS_PER_LINE) -> DataFrame:
    """In how many stretches a word occurs."""
    return (
        explode_once(_stretches(tokenized, max_words), F.col("words"), "w")
        .groupBy("w")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def pair_counts(
    tokenized: DataFrame,
    threshold: int = DEFAULT_THRESHOLD,
    max_words: int = MAX_WORDS_PER_LINE,
) -> DataFrame:
    """Unordered pairs ``x < y`` that share a stretch, with the number of such stretches.

    A stretch gives a bounded number of pairs, each one once: half of what the
    two directions would shuffle. Tasks count them before they move.
    """
    return _pairs(cell_counts(_stretches(tokenized, max_words), threshold)).select("x", "y", "n")


def _pairs(counts: DataFrame) -> DataFrame:
    return counts.filter("kind = 'pair'").drop("kind")


def mirror(pairs: DataFrame) -> DataFrame:
    """Both directions of every unordered pair, other columns repeated."""
    rest = [c for c in pairs.columns if c not in ("x", "y")]
    both = F.array(
        F.struct(F.col("x"), F.col("y")),
        F.struct(F.col("y").alias("x"), F.col("x").alias("y")),
    )
    return pairs.select(F.explode(both).alias("p"), *rest).select("p.x", "p.y", *rest)


class Counted(NamedTuple):
    """Counts of one pass over the stretches: ``pairs(x, y, n, n_x, n_y, n_stretches)`` with ``x < y``, ``words(w, n)`` and ``total(n_stretches)``."""

    pairs: DataFrame
    words: DataFrame
    total: DataFrame


def counted(
    tokenized: DataFrame,
    threshold: int = DEFAULT_THRESHOLD,
    max_words: int = MAX_WORDS_PER_LINE,
    place: str | None = None,
) -> Counted:
    """Pairs and words in ``threshold`` stretches or more, and the number of stretches, from one shuffle.

    Tasks count the words and pairs of many stretches together (:func:`cell_counts`), and
    the counts of a pair meet with those of its words. So tokens are found once and
    all counts are made together. They are stored below ``place``, by default in the
    shared folder of the session, for whatever needs them next. A word of a pair that
    passes is in as many stretches at least, so rarer words are not kept.
    """
    spark = tokenized.sparkSession
    place = place or new_run_dir(spark, "counts")
    counts = cell_counts(_stretches(tokenized, max_words), threshold)
    counts.write.mode("overwrite").partitionBy("kind").parquet(place)
    stored = spark.read.schema(COUNTS).parquet(place)
    return Counted(
        _pairs(stored),
        stored.filter("kind = 'word'").select(F.col("y").alias("w"), "n"),
        stored.filter("kind = 'total'").select(F.col("n").alias("n_stretches")),
    )


def pmi_pairs(
    tokenized: DataFrame,
    threshold: int = DEFAULT_THRESHOLD,
    max_words: int = MAX_WORDS_PER_LINE,
) -> DataFrame:
    """``(x, y, pmi, n)`` for both directions of pairs in ``threshold`` stretches or more."""
    return mirror(_with_pmi(_pairs(cell_counts(_stretches(tokenized, max_words), threshold))))


def _with_pmi(pairs: DataFrame) -> DataFrame:
    """PMI of counted unordered pairs; it is the same in both directions."""
    value = stats.pmi(F.col("n"), F.col("n_x"), F.col("n_y"), F.col("n_stretches"))
    return pairs.select("x", "y", value.alias("pmi"), "n")


def to_stripes(pairs: DataFrame, value: Column, max_entries: int = STRIPE_ENTRIES) -> DataFrame:
    """``(x, block, stripe)``: a map from ``y`` to ``value`` for every ``x``.

    ``fanout`` in ``pairs`` is the number of partners of ``x``. A word with up
    to ``max_entries`` has one row, block 0. A word with more is cut by a hash
    of ``y`` into blocks of about that many, since a frequent word can have a
    partner for every entry of the vocabulary.
    """
    blocks = F.ceil(F.col("fanout") / F.lit(max_entries))
    entry = F.struct(F.col("y"), value.alias("value"))
    return (
        pairs.select("x", F.pmod(F.xxhash64("y"), blocks).cast("int").alias("block"), entry.alias("e"))
        .groupBy("x", "block")
        .agg(F.map_from_entries(F.sort_array(F.collect_list("e"))).alias("stripe"))
    )


def pmi_stripes(
    tokenized: DataFrame,
    threshold: int = DEFAULT_THRESHOLD,
    max_words: int = MAX_WORDS_PER_LINE,
    max_entries: int = STRIPE_ENTRIES,
) -> DataFrame:
    """``(x, block, map<y, struct<pmi, n>>)``."""
    pairs = counted(tokenized, threshold, max_words).pairs
    partners = mirror(pairs).groupBy("x").agg(F.count(F.lit(1)).alias("fanout"))
    # Words with several blocks: one for ``max_entries`` pairs at most, so pairs need not move to meet them.
    wide = F.broadcast(partners.filter(F.col("fanout") > max_entries))
    scored = mirror(_with_pmi(pairs)).join(wide, "x", "left").withColumn("fanout", F.coalesce("fanout", F.lit(1)))
    return to_stripes(scored, F.struct("pmi", "n"), max_entries)


def bigram_counts(tokenized: DataFrame) -> DataFrame:
    """Neighbouring tokens ``(x, y, n)`` over the whole of every line."""
    at = explode_once(tokenized, F.col("tokens"), "i", "x", keep=["tokens"])
    return (
        at.select("x", F.get("tokens", F.col("i") + 1).alias("y"))
        .filter("y is not null")
        .groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bigram_frequencies(tokenized: DataFrame) -> DataFrame:
    """``(x, y, n, marginal, freq)`` with ``freq = n / marginal``.

    ``marginal`` is the number of bigrams that start with ``x``.
    """
    pairs = bigrams.pair_rows(bigrams.partial_stripes(tokenized), STRIPE_ENTRIES)
    return pairs.withColumn("freq", F.col("n") / F.col("marginal"))


def bigrams_with_marginals(tokenized: DataFrame) -> DataFrame:
    """Bigram rows plus one ``(x, "*")`` row per first word, with its marginal count."""
    pairs = bigram_counts(tokenized)
    marginals = pairs.groupBy("x").agg(F.sum("n").alias("n"))
    return pairs.unionByName(marginals.select("x", F.lit(MARGINAL_MARK).alias("y"), "n"))


def bigram_stripes(tokenized: DataFrame, max_entries: int = STRIPE_ENTRIES) -> DataFrame:
    """``(x, block, map<y, freq>)``, in blocks as :func:`to_stripes` has them."""
    return bigrams.stripe_rows(bigrams.partial_stripes(tokenized), max_entries)
