"""Inverted index and boolean retrieval.

An index is two tables: ``terms(term, df)`` and
``postings(term, block, postings array<struct<doc_id, tf>>)``. A block covers a
fixed range of document ids, so it holds at most ``docs_per_block`` postings
however frequent its term is. Blocks in order give the ids in ascending order.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import Window

from tallgrass.functions.tokens import explode_once, tokenize
from tallgrass.operators.buckets import estimated_bytes
from tallgrass.sources.sinks import save_sorted

DOCS_PER_BLOCK = 1 << 18
SNIPPET_CHARS = 80
#: Bytes of texts, as Spark estimates them, whose postings one task sorts and writes: in memory they are about fifteen times that.
FILE_BYTES = 4 << 20


class InvertedIndex(NamedTuple):
    terms: DataFrame
    postings: DataFrame


def term_frequencies(docs: DataFrame, letters: str = "a-z") -> DataFrame:
    """``(term, doc_id, tf)`` from ``docs(doc_id, text)``; ``doc_id`` is unique.

    A document is one row, so its terms are counted in place: its sorted tokens
    form runs of equal terms, and a run's length is the frequency. No posting
    is shuffled before the index groups them by term.
    """
    tokens = docs.select("doc_id", F.sort_array(tokenize("text", letters)).alias("sorted"))

    def start(token: Column, i: Column) -> Column:
        return F.when((i == 0) | (token != F.get("sorted", i - 1)), i)

    def count(at: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("sorted"))
        return F.struct(F.get("sorted", at).alias("term"), (end - at).cast("long").alias("tf"))

    runs = tokens.select("doc_id", "sorted", F.array_compact(F.transform("sorted", start)).alias("starts"))
    counted = explode_once(runs, F.transform("starts", count), "run", keep=["doc_id"])
    return counted.select("run.term", "doc_id", "run.tf")


def build_index(docs: DataFrame, docs_per_block: int = DOCS_PER_BLOCK) -> InvertedIndex:
    tf = term_frequencies(docs)
    terms = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    block = F.floor(F.col("doc_id") / F.lit(docs_per_block)).cast("long")
    postings = (
        tf.groupBy("term", block.alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))
    )
    return InvertedIndex(terms, postings)


def save_index(index: InvertedIndex, path: str, files: int) -> InvertedIndex:
    """Store an index in ``files`` files, or more if it is large, and return the stored one.

    A task sorts what goes into its file, so the number of files grows with the input.
    It is sorted by term, so that a lookup reads only the row groups of its
    terms. Document frequencies come from the stored postings: texts are not
    read again for them.
    """
    spark = index.postings.sparkSession
    files = max(files, -(-(estimated_bytes(index.postings) or 0) // FILE_BYTES))
    save_sorted(index.postings, f"{path}/postings", ["term", "block"], files)
    stored = spark.read.parquet(f"{path}/postings")
    df = F.sum(F.size("postings").cast("long")).alias("df")
    save_sorted(stored.groupBy("term").agg(df), f"{path}/terms", ["term"], files)
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> InvertedIndex:
    return InvertedIndex(spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/postings"))


def flat_postings(postings: DataFrame) -> DataFrame:
    """One row per posting: ``(term, doc_id, tf)``."""
    return postings.select("term", F.explode("postings").alias("p")).select("term", "p.*")


def gap_encode(postings: DataFrame) -> DataFrame:
    """Each id as its distance from the one before it in the block, the first from 0."""

    def gap(p: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(0)).otherwise(F.get("postings", i - 1)["doc_id"])
        return F.struct((p["doc_id"] - before).alias("gap"), p["tf"].alias("tf"))

    return postings.select("term", "block", F.transform("postings", gap).alias("gaps"))


def gap_decode(encoded: DataFrame) -> DataFrame:
    """Flat postings from gaps: a running sum inside every block."""
    flat = encoded.select("term", "block", F.posexplode("gaps").alias("pos", "g"))
    upto = Window.partitionBy("term", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return flat.select("term", F.sum("g.gap").over(upto).alias("doc_id"), F.col("g.tf").alias("tf"))


def lookup_terms(index: InvertedIndex, terms: list[str]) -> DataFrame:
    """Flat postings of the given terms; a term that is absent gives no rows."""
    return flat_postings(index.postings.filter(F.col("term").isin(terms)))


def docs_with(index: InvertedIndex, term: str) -> DataFrame:
    return lookup_terms(index, [term]).select("doc_id")


def docs_and(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def docs_or(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(right).distinct()


def postfix_terms(query: str) -> list[str]:
    """Different terms of a postfix query, in order."""
    return list(dict.fromkeys(t for t in query.split() if t not in ("AND", "OR")))


def postfix_ids(query: str, ids: dict[str, Column]) -> Column:
    """Fold a postfix query such as ``a b AND c OR`` into one array of ids."""
    operands: list[Column] = []
    for word in query.split():
        if word not in ("AND", "OR"):
            operands.append(ids[word])
            continue
        if len(operands) < 2:
            raise ValueError(f"{word} needs two operands in {query!r}")
        second, first = operands.pop(), operands.pop()
        combine = F.array_intersect if word == "AND" else F.array_union
        operands.append(combine(first, second))
    if len(operands) != 1:
        raise ValueError(f"{query!r} leaves {len(operands)} operands, expected 1")
    return operands[0]


def boolean_search(index: InvertedIndex, query: str) -> DataFrame:
    """Ids of the documents that match a postfix query, ascending.

    Terms are taken as written: not lower-cased and not tokenized. Blocks of
    all terms cover the same ranges of ids, so the query is answered block by
    block: one row per term and block is shuffled, not one per posting.
    """
    terms = postfix_terms(query)
    ids = {t: F.col(f"_ids_{i}") for i, t in enumerate(terms)}
    matching = postfix_ids(query, ids)
    # A term has at most one row per block: flattening gives its ids, or none.
    of_term = [
        F.flatten(F.collect_list(F.when(F.col("term") == t, F.col("ids")))).alias(f"_ids_{i}")
        for i, t in enumerate(terms)
    ]
    blocks = (
        index.postings.filter(F.col("term").isin(terms))
        .select("term", "block", F.col("postings.doc_id").alias("ids"))
        .groupBy("block")
        .agg(*of_term)
    )
    return explode_once(blocks, matching, "doc_id").orderBy("doc_id")


def snippet(text: str | Column, chars: int = SNIPPET_CHARS) -> Column:
    """The start of a text, marked with ``...`` when it goes on."""
    col = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(col) > chars, F.concat(F.substring(col, 1, chars), F.lit("..."))).otherwise(col)


def search_snippets(index: InvertedIndex, docs: DataFrame, query: str) -> DataFrame:
    """``(doc_id, snippet)`` of the matching documents, by id."""
    # Cut first: a join by shuffle then moves snippets, not whole texts.
    snippets = docs.select("doc_id", snippet("text").alias("snippet"))
    return snippets.join(boolean_search(index, query), "doc_id").orderBy("doc_id")
