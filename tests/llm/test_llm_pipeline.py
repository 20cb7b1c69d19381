import base64
import hashlib
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from compare import connect, difference
from conftest import SMALL

import __spark_entry__ as entry
from tallgrass.llm import common, mixing, oracle, quality
from test_llm_operators import plain_print, roots


def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def test_stages_keep_the_columns_and_their_decisions(spark):
    docs = common.table(spark, SMALL, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, SMALL), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert not seen or ids <= seen[-1]
        seen.append(ids)
        docs = out
    lowered = {r.t for r in common.table(spark, SMALL, "documents").selectExpr("lower(text) t").collect()}
    assert 0.7 * len(lowered) < len(seen[2]) <= len(lowered)


def test_queries_are_registered_and_equal_their_sql(spark):
    queries = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in queries if n.startswith("op")} == set(range(1, 14)) and "pipeline" in queries
    con = connect(SMALL)
    for name, sql in oracle.all_sql().items():
        assert difference(queries[name](spark, SMALL), con, sql) is None


def test_every_stage_equals_a_plain_version_of_it(spark):
    """Each stage on what the one before kept: votes by the trained model, copies, fingerprints, takes and tokens."""
    docs = common.table(spark, SMALL, "documents")
    labels = common.table(spark, SMALL, "labels")
    stages = dict(corpus_pipeline.STAGES)

    scores = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    good = common.stored(stages["quality"](spark, docs, SMALL), "good")
    assert {r.doc_id for r in good.collect()} == {d for d in rows if scores[d] >= 0.3}

    lowered = {}
    for d in sorted(d for d in rows if scores[d] >= 0.3):
        lowered[rows[d].encode().lower()] = d  # the largest id stays
    single = common.stored(stages["exact_dedup"](spark, good, SMALL), "single")
    assert sorted(r.doc_id for r in single.collect()) == sorted(lowered.values())

    prints = {d: plain_print(rows[d]) for d in lowered.values()}
    root = roots(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    apart = common.stored(stages["near_dedup"](spark, single, SMALL), "apart")
    assert sorted(r.doc_id for r in apart.collect()) == sorted(d for d in prints if root[d] == d)

    words = {r.doc_id: (r.size, r.taken) for r in mixing.taken(apart).collect()}
    mixed = common.stored(stages["mix"](spark, apart, SMALL), "mixed")
    times = Counter(r.doc_id for r in mixed.collect())
    assert times == Counter({d: -(-taken // size) for d, (size, taken) in words.items() if taken})

    encoding = tiktoken.Encoding("b", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    for r in stages["tokens"](spark, mixed, SMALL).collect():
        ids = encoding.encode_ordinary(rows[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
