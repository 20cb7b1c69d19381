"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallgrass.llm import bpe, chat, codes, dedup, embeddings, merkle, mixing, passages, pii, quality, sharding, simhash, urls
from tallgrass.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


@query
def op1_pii(spark, sf_dir):
    return pii.digests(table(spark, sf_dir, "documents"))


@query
def op2_exact_dedup(spark, sf_dir):
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_mix_sources(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents")).drop("_key")


@query
def op4_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op5_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.page_outcomes(pages, table(spark, sf_dir, "labels")))


@query
def op6_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op7_passages(spark, sf_dir):
    return passages.digests(table(spark, sf_dir, "documents"))


@query
def op8_shards(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


@query
def op9_embeddings(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_vector_codes(spark, sf_dir):
    return codes.digests(table(spark, sf_dir, "embeddings"))


@query
def op12_chat_format(spark, sf_dir):
    return chat.digests(chat.formatted(chat.conversations(table(spark, sf_dir, "conversations"))))


@query
def op13_merkle(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("proof")
