"""Properties that every plan must have to hold at scale."""

import re
from pathlib import Path

import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tallgrass.operators import classifier, graph
from tallgrass.operators.bloom import bloom_filter, maybe_in
from tallgrass.operators.buckets import read_buckets, write_buckets
from tallgrass.plans import queries as registered

ROOT = Path(__file__).resolve().parent.parent
QUERIES = registered.all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["word_line_freq", "pair_counts", "bigram_freq", "doc_tf"])
def test_the_tokenizer_is_not_repeated_in_a_filter(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract_all" in line]


def test_top_nodes_are_cut_before_the_shuffle(spark):
    ranks = spark.range(100).select("id", F.lit(1).alias("source"), F.rand(1).alias("score"))
    assert "WindowGroupLimit" in plan_of(graph.top_nodes(ranks, 5))


def exchanges(plan: str) -> list[str]:
    return [line.strip() for line in plan.splitlines() if re.search(r"\bExchange (hash|range|Round|Single)", line)]


def test_only_messages_move_in_an_iteration(spark, no_broadcast, tmp_path):
    """One shuffle in a whole iteration: of the messages, by their end, into the buckets of the state."""
    edges = spark.range(500).select((F.col("id") % 50).alias("src"), (F.col("id") % 7).alias("dst"))
    layout = graph.lay_out(graph.build_graph(spark.range(50), edges), str(tmp_path))
    graph.start_state(graph.Graph(spark.range(50), edges), [1], str(tmp_path), layout=layout)
    stage = graph.open_stage(spark, layout)
    state = read_buckets(stage.session, str(tmp_path / "iter=0000"), "id", layout.buckets, "id bigint, degree bigint, m0 double")
    plan = plan_of(graph.next_masses(stage, [1], state, [F.lit(0.0)]))
    assert len(exchanges(plan)) == 1 and "hashpartitioning(dst#" in exchanges(plan)[0], plan
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan


def test_occurrences_stay_in_a_training_step(spark, no_broadcast, tmp_path):
    """Two shuffles in a step: scores by document, gradients by feature."""
    rows = spark.range(200).selectExpr("id doc_id", "if(id % 2 = 0, 'spam', 'ham') label", "array(cast(id % 7 as int), cast(id as int)) features")
    stage = classifier.open_stage(spark, classifier.store_occurrences(rows, str(tmp_path)))._replace(often=None)
    first = stage.session.range(200).selectExpr("cast(id as int) feature", "0.0D weight")
    write_buckets(first, str(tmp_path / "w"), "feature", stage.buckets)
    weights = read_buckets(stage.session, str(tmp_path / "w"), "feature", stage.buckets, "feature int, weight double")
    plan = plan_of(classifier.next_weights(stage, weights, 0, 0.1))
    assert [re.search(r"hashpartitioning\((\w+)#", e)[1] for e in exchanges(plan)] == ["feature", "doc_id"], plan
    assert "SortMergeJoin" not in plan


def test_lines_of_other_orders_are_dropped_before_the_shuffle(spark, no_broadcast):
    plan = plan_of(QUERIES["q5_shipments_by_month"](spark, SMALL)).splitlines()
    shuffled = next(i for i, line in enumerate(plan) if re.search(r"Exchange hashpartitioning\(l_orderkey#\w+, ", line))
    filtered = next(i for i, line in enumerate(plan) if re.search(r"BroadcastHashJoin \[_word#.*_bits#", line))
    scan = next(i for i, line in enumerate(plan) if "FileScan parquet [l_orderkey#" in line and "l_shipdate#" in line)
    assert shuffled < filtered < scan
    assert sum("FileScan parquet [l_orderkey#" in line for line in plan) == 1


@pytest.mark.parametrize("words", [4, 64, 1 << 16])
def test_a_bloom_filter_keeps_every_wanted_row(spark, words):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("k"))
    rows = spark.range(12_000).select(F.col("id").alias("k"), F.lit("x").alias("_other"))
    bloom = bloom_filter(keys, "k", words)
    assert bloom.count() <= words
    kept = {r.k for r in maybe_in(rows, "k", bloom, words).collect()}
    assert kept >= set(range(0, 3000, 3))
    assert words < 1 << 16 or len(kept) < 1100


def test_tokens_are_found_once_for_all_counts(spark, monkeypatch):
    """Pairs, words and stretches come out of one plan with one tokenizer and one shuffle."""
    written = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, f=DataFrameWriter.parquet, **k: (written.append(plan_of(self._df)), f(self, path, **k))[1])
    after = plan_of(QUERIES["pmi_stripes"](spark, SMALL))
    assert "regexp_extract_all" not in after
    assert [p.count("regexp_extract_all") for p in written] == [1] and len([e for e in exchanges(written[0]) if "x#" in e]) == 1


@pytest.mark.parametrize("name", ["score_docs", "ensemble_average", "ensemble_vote", "train_batches"])
def test_features_are_hashed_once_for_models_and_scores(spark, monkeypatch, name):
    written = []
    for way in ("save", "parquet"):
        monkeypatch.setattr(DataFrameWriter, way, lambda self, path=None, f=getattr(DataFrameWriter, way), **k: (written.append(plan_of(self._df)), f(self, path, **k))[1])
    plans = [plan_of(QUERIES[name](spark, SMALL)), *written]
    assert sum(p.count("regexp_extract_all") for p in plans) == 1


def test_sources_avoid_what_does_not_scale():
    for file in (ROOT / "tallgrass").rglob("*.py"):
        body = file.read_text()
        for word in ("localCheckpoint", "crossJoin", ".collect()", ".toPandas(", "collectAsMap", "foreachBatch"):
            assert word not in body, (file, word)


def test_features_are_counted_in_pieces_whose_number_grows_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(registered, "PIECE_BYTES", 1 << 12)
    pieces = registered._pieces(spark, SMALL)
    assert pieces > 20
    plan = plan_of(registered.features(spark, SMALL))
    assert len(re.findall(rf", {pieces}\), REPARTITION_BY_NUM", plan)) == 2
    # No aggregate holds a task's input before its occurrences meet those of others.
    assert "partial_count" not in plan.split("REPARTITION_BY_NUM", 1)[1]
