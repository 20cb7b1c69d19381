import math
import random

import pytest
from pyspark.sql import functions as F

from tallgrass.functions.stats import log_sums
from tallgrass.operators import graph
from tallgrass.sources.records import parse_adjacency

RNG = random.Random(11)
NODES = list(range(40))
# A hub with many targets, repeated edges, targets that are no node, nodes without edges.
EDGES = (
    [(0, RNG.randrange(50)) for _ in range(120)]
    + [(RNG.randrange(30), RNG.randrange(45)) for _ in range(150)]
    + [(3, 4)] * 7
)


def brute(sources, iterations):
    out = {n: [d for s, d in EDGES if s == n] for n in NODES}
    result = {}
    for s in sources:
        p = {n: float(n == s) for n in NODES}
        for _ in range(iterations):
            arrived = dict.fromkeys(NODES, 0.0)
            for n in NODES:
                for d in out[n]:
                    if d in arrived:
                        arrived[d] += p[n] / len(out[n])
            lost = max(0.0, 1 - sum(arrived.values()))
            p = {n: 0.85 * (arrived[n] + (lost if n == s else 0)) + (0.15 if n == s else 0) for n in NODES}
        result[s] = p
    return result


@pytest.fixture
def make(spark):
    def build(nodes=NODES, edges=EDGES):
        return graph.build_graph(
            spark.createDataFrame([(n,) for n in nodes], "id long"),
            spark.createDataFrame(edges, "src long, dst long"),
        )

    return build


def ranks_of(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.source, {})[r.id] = r.score
    return found


@pytest.mark.parametrize("iterations", [0, 1, 4])
@pytest.mark.parametrize("edges_per_block", [5, 1000])
def test_ranks_equal_brute_force(make, iterations, edges_per_block):
    got = ranks_of(graph.personalized_pagerank(make(), [0, 3, 39], iterations, edges_per_block=edges_per_block))
    wanted = brute([0, 3, 39], iterations)
    for s in wanted:
        assert got[s] == pytest.approx(wanted[s])
        assert sum(got[s].values()) == pytest.approx(1)


def test_ranks_with_shuffle_joins_and_source_groups(make, no_broadcast, monkeypatch):
    monkeypatch.setattr(graph, "SOURCES_PER_RUN", 2)
    got = ranks_of(graph.personalized_pagerank(make(), [5, 0, 9], 2, edges_per_block=7))
    wanted = brute([5, 0, 9], 2)
    assert all(got[s] == pytest.approx(wanted[s]) for s in wanted)


def test_hub_edges_are_split_and_complete(spark, make, tmp_path):
    layout = graph.lay_out(make(), str(tmp_path), edges_per_block=5)
    split = {r.id for r in spark.read.parquet(f"{layout.path}/split").collect()}
    targets = {n: len({d for s, d in EDGES if s == n}) for n in {s for s, _ in EDGES}}
    assert split == {n for n, many in targets.items() if many > 5} and 0 in split and layout.split_nodes == len(split)
    hub, rest = (spark.read.parquet(f"{layout.path}/{name}") for name in ("split_edges", "edge_buckets"))
    assert {r.src for r in hub.collect()} == split and not split & {r.src for r in rest.collect()}
    assert hub.filter("src = 0").agg(F.sum("weight")).first()[0] == sum(s == 0 for s, _ in EDGES)
    topology = {r.id: r.degree for r in spark.read.parquet(f"{layout.path}/topology").collect()}
    assert topology == {n: sum(s == n for s, _ in EDGES) for n in NODES}
    assert graph.open_layout(spark, str(tmp_path)) == layout


def test_a_layout_needs_no_catalog(spark, make, tmp_path):
    graph.personalized_pagerank(make(), [0], 1, base=str(tmp_path / "r")).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tallgrass")]
    other = spark.newSession()
    graph.advance(graph.Graph(other.range(0), None), [0], str(tmp_path / "r" / "sources=0"), 1, 3, graph.open_layout(other, str(tmp_path / "r")))
    assert ranks_of(graph.read_ranks(other, [0], str(tmp_path / "r" / "sources=0"), 3))[0] == pytest.approx(brute([0], 3)[0])


def test_run_goes_on_from_a_stored_iteration(spark, make, tmp_path):
    base = str(tmp_path / "run")
    built = make()
    graph.start_state(built, [0], base)
    graph.advance(built, [0], base, 0, 2)
    graph.advance(built, [0], base, 2, 4)
    assert ranks_of(graph.read_ranks(spark, [0], base, 4))[0] == pytest.approx(brute([0], 4)[0])


def test_stored_graph_gives_the_same(spark, make, tmp_path):
    assert graph.save_graph(make(), str(tmp_path / "g")).edges.count() == len(set(EDGES))
    stored = graph.partition_graph(graph.load_graph(spark, str(tmp_path / "g")), 3)
    assert stored.edges.rdd.getNumPartitions() == 3
    assert ranks_of(graph.personalized_pagerank(stored, [0], 2))[0] == pytest.approx(brute([0], 2)[0])


def test_stats_and_orphans(make):
    row = graph.graph_stats(make()).first()
    active = {s for s, _ in EDGES}
    assert (row.nodes, row.edges, row.active_nodes, row.dangling_nodes) == (
        40, len(EDGES), len(active), 40 - len(active),
    )
    orphans = {r.dst: r.edges for r in graph.orphan_targets(make()).collect()}
    assert orphans == {d: sum(e[1] == d for e in EDGES) for _, d in EDGES if d >= 40}


def test_unknown_source_and_repeated_node_raise(make):
    with pytest.raises(ValueError, match="sources"):
        graph.personalized_pagerank(make(), [0, 999], 1)
    with pytest.raises(ValueError, match="more than once"):
        graph.personalized_pagerank(make(nodes=NODES + [3]), [0], 1)
    with pytest.raises(ValueError):
        graph.personalized_pagerank(make(), [], 1)


@pytest.mark.parametrize("k, shards", [(3, 1), (3, 8), (100, 8)])
def test_top_nodes(spark, k, shards):
    rows = [(i, s, float((i * 7) % 5) if i < 20 else 0.0) for i in range(30) for s in (1, 2)]
    ranks = spark.createDataFrame(rows, "id long, source long, score double")
    got = [(r.source, r["rank"], r.id) for r in graph.top_nodes(ranks, k, shards).orderBy("source", "rank").collect()]
    wanted = []
    for s in (1, 2):
        best = sorted((r for r in rows if r[1] == s), key=lambda r: (-r[2], r[0]))[:k]
        wanted += [(s, i + 1, r[0]) for i, r in enumerate(best)]
    assert got == wanted


def test_adjacency_text(spark):
    lines = spark.createDataFrame([("1 2 2 3",), ("2",), ("",), ("  3   1 ",)], "value string")
    records = parse_adjacency(lines)
    assert {r.id: r.neighbors for r in records.collect()} == {1: [2, 2, 3], 2: [], 3: [1]}
    row = graph.graph_stats(graph.graph_from_adjacency(records)).first()
    assert (row.nodes, row.edges, row.dangling_nodes) == (3, 4, 1)


def test_source_list_and_ranking_lines(spark):
    assert graph.parse_sources("3, 1,2") == [3, 1, 2]
    ranks = spark.createDataFrame([(5, 1, 0.25), (6, 1, 1 / 3)], "id long, source long, score double")
    lines = graph.ranking_lines(graph.top_nodes(ranks, 2)).orderBy("rank")
    assert [r.line for r in lines.collect()] == ["0.33333 6", "0.25000 5"]


def test_mass_totals(spark, make, tmp_path):
    base = str(tmp_path)
    built = make()
    graph.start_state(built, [0, 39], base)
    graph.advance(built, [0, 39], base, 0, 1)
    got = {r.source: r for r in graph.mass_totals(spark, [0, 39], base, 1).collect()}
    inside = [d for s, d in EDGES if s == 0 and d < 40]
    assert got[0].arrived == pytest.approx(len(inside) / sum(s == 0 for s, _ in EDGES))
    assert got[0].reached_nodes == len(set(inside))
    assert (got[39].arrived, got[39].missing, got[39].reached_nodes) == (0.0, 1.0, 0)


def test_a_state_left_half_written_is_written_anew(spark, make, tmp_path):
    base, built = str(tmp_path), make()
    graph.start_state(built, [0], base)
    graph.advance(built, [0], base, 0, 2)
    graph.advance(built, [0], base, 1, 2)
    assert [r.iteration for r in graph.iteration_counters(spark, [0], base).orderBy("iteration").collect()] == [1, 2]
    assert spark.read.parquet(f"{base}/iter=0002").count() == len(NODES)
    assert ranks_of(graph.read_ranks(spark, [0], base, 2))[0] == pytest.approx(brute([0], 2)[0])


def test_counters_are_those_of_the_stored_state(spark, make, tmp_path):
    base, built = str(tmp_path), make()
    graph.start_state(built, [0, 39], base)
    graph.advance(built, [0, 39], base, 0, 2)
    found = {(r.iteration, r.source): r for r in graph.iteration_counters(spark, [0, 39], base).collect()}
    for i in (1, 2):
        for r in graph.mass_totals(spark, [0, 39], base, i).collect():
            got = found[i, r.source]
            assert (got.arrived, got.missing, got.nodes) == (pytest.approx(r.arrived), pytest.approx(r.missing), len(NODES))
    state = spark.read.parquet(f"{base}/iter=0002")
    assert found[2, 0].reached == state.filter("m0 > 0 or m1 > 0").count()


@pytest.mark.parametrize("iterations", [0, 1, 4])
def test_log_ranks_are_logarithms_of_the_ranks(make, iterations):
    wanted = {(n, s): p for s, ps in brute([0, 3, 39], iterations).items() for n, p in ps.items() if p > 0}
    found = {(r.id, r.source): math.exp(r.log_score) for r in graph.log_pagerank(make(), [0, 3, 39], iterations).collect()}
    assert found == {k: pytest.approx(p) for k, p in wanted.items()}


def test_masses_that_a_double_cannot_hold(spark):
    """Masses of e^-2000 beside larger and smaller ones: in doubles all are zero."""
    rows = [(1, 1, 9, -2000.0), (2, 1, 9, -2000.5), (3, 2, 9, -2600.0), (4, 1, 8, -3.0)]
    state = spark.createDataFrame(rows, "id long, targets long, source long, rank double")
    edges = spark.createDataFrame([(1, 7, 0.5), (2, 7, 0.25), (3, 7, 1.0), (3, 6, 1.0), (4, 7, 1.0)], "src long, dst long, share double")
    found = {(r.id, r.source): r.mass for r in graph.log_messages(edges, state).collect()}
    assert found[7, 9] == pytest.approx(-2000 + math.log(0.5 + 0.25 * math.exp(-0.5)), rel=1e-12)
    assert found[6, 9] == -2600 and found[7, 8] == -3 and math.exp(found[7, 9]) == 0


def test_log_sums(spark):
    values = [-1e6, -1e6 + 1, -255.9, -256.0, 0.0, 700.0, 900.0, None]
    rows = [(k, v) for k, some in enumerate([values[:2], values[:4], values[3:5], values[4:7], [None, 1.0], [None]]) for v in some]
    found = {r.k: r.v for r in log_sums(spark.createDataFrame(rows, "k int, v double"), ["k"], "v").collect()}
    for k in range(5):
        some = [v for n, v in rows if n == k and v is not None]
        assert found[k] == pytest.approx(max(some) + math.log(sum(math.exp(v - max(some)) for v in some)), rel=1e-12)
    assert 5 not in found
