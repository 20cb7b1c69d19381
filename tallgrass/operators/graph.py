"""Personalized PageRank from several sources at once.

Ranks are doubles in one column per source (``m0``, ``m1``, …), so a message
along an edge is one row whatever the number of sources. Edges lie in buckets of
their start, masses in the same buckets of their node: an iteration shuffles the
messages, summed per task before, and nothing else.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import Window

from tallgrass.functions.stats import log_sums
from tallgrass.functions.tokens import explode_once
from tallgrass.operators.buckets import bucket_session, buckets_for, read_buckets, schema_of, write_buckets
from tallgrass.operators.skew import HOT_KEYS, hottest, lookup_join, lookup_used
from tallgrass.session import new_run_dir

JUMP = 0.15  # fixed value: probability of a jump back to the source
EDGES_PER_BLOCK = 1_000_000
SOURCES_PER_RUN = 64
TOP_SHARDS = 1024


class Graph(NamedTuple):
    """``nodes(id)`` and ``edges(src, dst, weight)``; ``weight`` counts repeats of an edge. ``place``: where it is stored."""

    nodes: DataFrame
    edges: DataFrame
    place: str | None = None


def adjacency_edges(adjacency: DataFrame) -> DataFrame:
    """``(id, neighbors)`` → ``(src, dst)``, one row per listed neighbour."""
    edges = explode_once(adjacency, F.col("neighbors"), "dst", keep=["id"])
    return edges.withColumnRenamed("id", "src")


def build_graph(nodes: DataFrame, edges: DataFrame) -> Graph:
    """A graph from ``nodes(id)`` and ``edges(src, dst)``, repeats allowed.

    Edges out of an id that is no node never carry anything. What edges into
    such an id carry is lost.
    """
    return Graph(
        nodes.select("id"), edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    )


def graph_from_adjacency(adjacency: DataFrame) -> Graph:
    """A graph from parsed adjacency records: every record is a node."""
    return build_graph(adjacency, adjacency_edges(adjacency))


def save_graph(graph: Graph, path: str) -> Graph:
    """Store a graph and return the stored one: raw edges are then read only once."""
    graph.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    graph.edges.write.mode("overwrite").parquet(f"{path}/edges")
    return load_graph(graph.nodes.sparkSession, path)


def load_graph(spark: SparkSession, path: str) -> Graph:
    return Graph(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"), path)


def partition_graph(graph: Graph, parts: int) -> Graph:
    """``parts`` partitions by node id; edges are spread by both their ends."""
    return Graph(graph.nodes.repartition(parts, "id"), graph.edges.repartition(parts, "src", "dst"))


def _degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(
        F.sum("weight").alias("degree"), F.count(F.lit(1)).alias("targets")
    )


def graph_stats(graph: Graph) -> DataFrame:
    """``(nodes, edges, active_nodes, dangling_nodes)``; repeats of an edge count."""
    degree = F.coalesce("degree", F.lit(0))
    return graph.nodes.join(_degrees(graph.edges), "id", "left").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.sum(degree).alias("edges"),
        F.sum((degree > 0).cast("long")).alias("active_nodes"),
        F.sum((degree == 0).cast("long")).alias("dangling_nodes"),
    )


def orphan_targets(graph: Graph) -> DataFrame:
    """``(dst, edges)``: ids that receive edges from nodes but are no node."""
    known = graph.nodes.select(F.col("id").alias("src"), F.lit(True).alias("known"))
    inbound = (
        lookup_used(graph.edges, known, "src", spread_by=["src", "dst"])
        .groupBy("dst")
        .agg(F.sum("weight").alias("edges"))
    )
    return inbound.join(graph.nodes.select(F.col("id").alias("dst")), "dst", "left_anti")


def _mass_columns(sources: Sequence[int]) -> list[str]:
    return [f"m{i}" for i in range(len(sources))]


def _state_path(base: str, iteration: int) -> str:
    return f"{base}/iter={iteration:04d}"


class Layout(NamedTuple):
    """A graph as it is stored for iterations, below ``path``.

    ``topology`` holds ``id, degree`` in buckets by ``id``, ``edge_buckets`` the edges in
    buckets by ``src``. If there are split nodes, ``split`` has their ids, ``HOT_KEYS`` at
    most, and ``split_edges`` their edges, spread over all files.
    """

    path: str
    buckets: int
    split_nodes: int
    id_type: str
    edge_schema: str


def lay_out(graph: Graph, path: str, edges_per_block: int = EDGES_PER_BLOCK) -> Layout:
    """Store a graph for :func:`start_state` and :func:`advance`: the only time that edges are shuffled.

    Split are the nodes with more than ``edges_per_block`` targets, among the ``HOT_KEYS``
    with most. Any other node has a bounded share of the edges. The number of buckets
    follows from the size of the stored edges. Raises if a node occurs more than once,
    which is counted while the nodes are written.
    """
    if graph.place is None:
        graph = save_graph(graph, f"{path}/graph")
    spark = graph.nodes.sparkSession
    buckets = buckets_for(graph.edges)
    inner = bucket_session(spark, buckets)
    stored = load_graph(inner, graph.place)
    degrees = _degrees(stored.edges)
    many = F.col("targets") > edges_per_block
    seen = Observation()
    nodes = stored.nodes.groupBy("id").agg(F.count(F.lit(1)).alias("copies")).join(degrees, "id", "left")
    counted = nodes.observe(seen, F.count_if(F.col("copies") > 1).alias("repeated"), F.count_if(many).alias("many"))
    write_buckets(counted.select("id", F.coalesce("degree", F.lit(0)).alias("degree")), f"{path}/topology", "id", buckets)
    if seen.get["repeated"]:
        raise ValueError(f"{seen.get['repeated']} node ids occur more than once")
    edges, split_nodes = stored.edges, min(seen.get["many"], HOT_KEYS)
    if split_nodes:
        hottest(degrees, "id", "targets").filter(many).select("id").write.mode("overwrite").parquet(f"{path}/split")
        split = F.broadcast(inner.read.parquet(f"{path}/split").select(F.col("id").alias("src")))
        edges.join(split, "src", "left_semi").write.mode("overwrite").parquet(f"{path}/split_edges")
        edges = edges.join(split, "src", "left_anti")
    write_buckets(edges.repartition(buckets, "src"), f"{path}/edge_buckets", "src", buckets)
    layout = Layout(path, buckets, split_nodes, stored.nodes.schema["id"].dataType.simpleString(), schema_of(edges))
    kept = [F.lit(v).alias(n) for n, v in layout._asdict().items() if n != "path"]
    spark.range(1).select(*kept).write.mode("overwrite").parquet(f"{path}/layout")
    return layout


def open_layout(spark: SparkSession, path: str) -> Layout:
    """The layout that an earlier run, also of another session, has stored."""
    return Layout(path, **spark.read.parquet(f"{path}/layout").first().asDict())


class Stage(NamedTuple):
    """The tables of a layout, opened once for all iterations."""

    session: SparkSession
    layout: Layout
    edges: DataFrame
    split: DataFrame | None
    split_edges: DataFrame | None


def open_stage(spark: SparkSession, layout: Layout) -> Stage:
    inner = bucket_session(spark, layout.buckets)
    edges = read_buckets(inner, f"{layout.path}/edge_buckets", "src", layout.buckets, layout.edge_schema)
    if not layout.split_nodes:
        return Stage(inner, layout, edges, None, None)
    split = inner.read.parquet(f"{layout.path}/split").withColumnRenamed("id", "src")
    return Stage(inner, layout, edges, split, inner.read.parquet(f"{layout.path}/split_edges"))


def _read_state(stage: Stage, sources: Sequence[int], base: str, iteration: int) -> DataFrame:
    schema = ", ".join([f"id {stage.layout.id_type}", "degree bigint", *[f"{c} double" for c in _mass_columns(sources)]])
    return read_buckets(stage.session, _state_path(base, iteration), "id", stage.layout.buckets, schema)


def _write_state(state: DataFrame, sources: Sequence[int], base: str, iteration: int, buckets: int) -> dict:
    """Write the masses of an iteration; what :func:`_counters` names is counted on the way."""
    seen = Observation()
    counted = state.observe(seen, *_counters(sources))
    write_buckets(counted, _state_path(base, iteration), "id", buckets)
    return seen.get


def _counters(sources: Sequence[int]) -> list[Column]:
    columns = _mass_columns(sources)
    arrived = [F.coalesce(F.sum(c), F.lit(0.0)).alias(f"arrived_{c}") for c in columns]
    reached = F.count_if(F.greatest(*columns, F.lit(0.0)) > 0).alias("reached")
    return [F.count(F.lit(1)).alias("nodes"), reached, F.count_if(F.col("id").isin(list(sources))).alias("sources"), *arrived]


def read_counters(spark: SparkSession, base: str) -> DataFrame:
    """``(iteration, nodes, reached, arrived)`` as counted while the states were written.

    ``reached`` are the nodes with any mass, ``arrived`` the mass per source before any
    of it returns.
    """
    return spark.read.parquet(f"{base}/counters").select("iteration", "nodes", "reached", "arrived")


def _ranks(arrived: list[Column], sources: Sequence[int]) -> dict[str, Column]:
    """Rank per source, by its column, from the mass that arrived at every node.

    What did not arrive anywhere returns to the source, which also gets the
    random jump.
    """
    ranks = {}
    for source, c, held in zip(sources, _mass_columns(sources), arrived):
        lost = F.greatest(F.lit(0.0), 1.0 - held)
        back = F.when(F.col("id") == F.lit(source), (1.0 - JUMP) * lost + JUMP).otherwise(F.lit(0.0))
        ranks[c] = F.col(c) * F.lit(1.0 - JUMP) + back
    return ranks


def _arrived_in(state: DataFrame, sources: Sequence[int]) -> list[Column]:
    """The mass that a stored state holds per source, as part of whatever plan uses it."""
    columns = _mass_columns(sources)
    sums = state.agg(F.array(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in columns]).alias("held")).scalar()
    return [F.get(sums, F.lit(i)) for i in range(len(columns))]


def start_state(
    graph: Graph, sources: Sequence[int], base: str, edges_per_block: int = EDGES_PER_BLOCK, layout: Layout | None = None
) -> None:
    """Write iteration 0: no mass has arrived yet, so all of it is at the source.

    The graph is laid out below ``base`` unless it is already. Raises if a source is
    no node, which is counted while the state is written.
    """
    layout = layout or lay_out(graph, base, edges_per_block)
    inner = bucket_session(graph.nodes.sparkSession, layout.buckets)
    topology = read_buckets(inner, f"{layout.path}/topology", "id", layout.buckets, f"id {layout.id_type}, degree bigint")
    state = topology.select("id", "degree", *[F.lit(0.0).alias(c) for c in _mass_columns(sources)])
    got = _write_state(state, sources, base, 0, layout.buckets)
    if got["sources"] != len(sources):
        raise ValueError(f"not all sources {list(sources)} are nodes")


def messages(stage: Stage, moving: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(id, *columns)``: what arrives at every id, from ``moving(src, *columns)``, what a node sends along each edge.

    Edges and senders meet in their buckets. What split nodes send is broadcast to
    where their edges are.
    """
    carried = [F.sum(F.col(c) * F.col("weight")).alias(c) for c in columns]
    met = stage.edges.join(moving.hint("shuffle_hash"), "src")
    if stage.split is not None:
        few = moving.join(F.broadcast(stage.split), "src", "left_semi")
        met = met.unionByName(stage.split_edges.join(F.broadcast(few), "src"))
    return met.groupBy(F.col("dst").alias("id")).agg(*carried)


def next_masses(stage: Stage, sources: Sequence[int], state: DataFrame, arrived: list[Column]) -> DataFrame:
    """The state after one more iteration: one shuffle, of the messages, into the buckets of the state."""
    columns, ranks = _mass_columns(sources), _ranks(arrived, sources)
    sends = (F.col("degree") > 0) & (F.greatest(*ranks.values(), F.lit(0.0)) > 0)
    shares = [(rank / F.col("degree")).alias(c) for c, rank in ranks.items()]
    moving = state.filter(sends).select(F.col("id").alias("src"), *shares)
    received = messages(stage, moving, columns).hint("shuffle_hash")
    kept = [F.coalesce(received[c], F.lit(0.0)).alias(c) for c in columns]
    return state.join(received, "id", "left").select("id", "degree", *kept)


def advance(
    graph: Graph, sources: Sequence[int], base: str, start: int, end: int, layout: Layout | None = None
) -> None:
    """Run iterations ``start`` to ``end - 1``; each reads and writes one state table.

    Every table is complete, so a broken run can go on from the last one, in another
    session too. Edges and masses are in buckets and stay where they are; nothing is
    held in memory from one iteration to the next. The mass that has arrived is counted
    while a state is written, so no job asks for it.
    """
    spark = graph.nodes.sparkSession
    layout = layout or open_layout(spark, base)
    stage = open_stage(spark, layout)
    columns = _mass_columns(sources)
    arrived, rows = None, []
    for i in range(start, end):
        state = _read_state(stage, sources, base, i)
        got = _write_state(next_masses(stage, sources, state, arrived or _arrived_in(state, sources)), sources, base, i + 1, layout.buckets)
        arrived = [F.lit(float(got[f"arrived_{c}"])) for c in columns]
        rows.append((i + 1, got["nodes"], got["reached"], [float(got[f"arrived_{c}"]) for c in columns]))
    if rows:
        names = ("iteration", "nodes", "reached", "arrived")
        counted = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
        one = stage.session.range(1, numPartitions=1).select(F.inline(F.array(*counted)))
        one.write.mode("append").parquet(f"{base}/counters")


def _per_source(sources: Sequence[int], name: str) -> Column:
    return F.array(
        *[
            F.struct(F.lit(s).cast("long").alias("source"), F.col(c).alias(name))
            for s, c in zip(sources, _mass_columns(sources))
        ]
    )


def mass_totals(spark: SparkSession, sources: Sequence[int], base: str, iteration: int) -> DataFrame:
    """``(source, arrived, missing, reached_nodes)`` of one iteration, before any of it returns."""
    state = spark.read.parquet(_state_path(base, iteration))
    return (
        state.select(F.explode(_per_source(sources, "mass")).alias("r"))
        .groupBy("r.source")
        .agg(F.sum("r.mass").alias("arrived"), F.sum((F.col("r.mass") > 0).cast("long")).alias("reached_nodes"))
        .select("source", "arrived", F.greatest(F.lit(0.0), 1 - F.col("arrived")).alias("missing"), "reached_nodes")
    )


def iteration_counters(spark: SparkSession, sources: Sequence[int], base: str) -> DataFrame:
    """``(iteration, source, nodes, reached, arrived, missing)`` of all iterations so far, from the counters alone."""
    named = [F.struct(F.lit(s).cast("long").alias("source"), F.get("arrived", F.lit(k)).alias("arrived")) for k, s in enumerate(sources)]
    # An iteration that was run again has counters of each run, all the same but for the order of sums.
    once = read_counters(spark, base).groupBy("iteration").agg(F.max("nodes").alias("nodes"), F.max("reached").alias("reached"), F.max("arrived").alias("arrived"))
    missing = F.greatest(F.lit(0.0), 1 - F.col("r.arrived"))
    rows = once.select("iteration", "nodes", "reached", F.explode(F.array(*named)).alias("r"))
    return rows.select("iteration", "r.source", "nodes", "reached", "r.arrived", missing.alias("missing"))


def read_ranks(spark: SparkSession, sources: Sequence[int], base: str, iteration: int) -> DataFrame:
    """``(id, source, score)`` after ``iteration`` iterations, all nodes included."""
    state = spark.read.parquet(_state_path(base, iteration))
    ranked = state.select("id", *[r.alias(c) for c, r in _ranks(_arrived_in(state, sources), sources).items()])
    return ranked.select("id", F.explode(_per_source(sources, "score")).alias("r")).select("id", "r.source", "r.score")


def personalized_pagerank(
    graph: Graph,
    sources: Sequence[int],
    iterations: int,
    base: str | None = None,
    edges_per_block: int = EDGES_PER_BLOCK,
) -> DataFrame:
    """``(id, source, score)`` after a number of iterations.

    The graph should be a stored one. State is written below ``base``, by
    default a new folder in the shared folder of the session. Long source lists
    run in groups over one layout of the graph.
    """
    sources = list(dict.fromkeys(sources))
    if not sources:
        raise ValueError("at least one source is needed")
    spark = graph.nodes.sparkSession
    base = base or new_run_dir(spark, "ranks")
    layout = lay_out(graph, base, edges_per_block)
    result = None
    for at in range(0, len(sources), SOURCES_PER_RUN):
        group = sources[at : at + SOURCES_PER_RUN]
        place = f"{base}/sources={at}"
        start_state(graph, group, place, layout=layout)
        advance(graph, group, place, 0, iterations, layout)
        ranks = read_ranks(spark, group, place, iterations)
        result = ranks if result is None else result.unionByName(ranks)
    return result


# ---- masses as logarithms ----


def _log_state_path(base: str, iteration: int) -> str:
    return f"{base}/log-iter={iteration:04d}"


def log_messages(edges: DataFrame, state: DataFrame) -> DataFrame:
    """``(id, source, mass)``: logarithms of the masses that arrive at every id, summed without leaving logarithms.

    ``edges`` are ``(src, dst, share)``, ``state`` is ``(id, targets, source, rank)``. The
    ranks of a node travel as one record, at most one entry per source of a run, and the
    edges of nodes with most ``targets`` stay spread.
    """
    ranks = F.collect_list(F.struct("source", "rank")).alias("ranks")
    senders = state.filter("targets > 0").groupBy(F.col("id").alias("src")).agg(F.max("targets").alias("targets"), ranks)
    sent = lookup_join(edges, senders, "src", "targets", ["src", "dst"]).filter("ranks is not null")
    each = sent.select(F.col("dst").alias("id"), "share", F.explode("ranks").alias("r"))
    carried = each.select("id", F.col("r.source").alias("source"), (F.col("r.rank") + F.ln("share")).alias("mass"))
    return log_sums(carried, ["id", "source"], "mass")


def log_pagerank(graph: Graph, sources: Sequence[int], iterations: int, base: str | None = None) -> DataFrame:
    """``(id, source, log_score)``, only nodes that hold any mass: ranks too small for a double keep their logarithm.

    State is in long form, one row per node reached and source, so a source that has
    reached few nodes has few rows. Every iteration is a complete table below ``base``.
    Long source lists run in groups over the same stored edges.
    """
    sources = list(dict.fromkeys(sources))
    if not sources:
        raise ValueError("at least one source is needed")
    spark = graph.nodes.sparkSession
    base = base or new_run_dir(spark, "log-ranks")
    degrees = _degrees(graph.edges)
    edges = lookup_join(graph.edges, degrees.withColumnRenamed("id", "src"), "src", "targets", ["src", "dst"])
    edges = lookup_used(edges, graph.nodes.select(F.col("id").alias("dst"), F.lit(True).alias("known")), "dst", ["src", "dst"])
    edges.select("src", "dst", (F.col("weight") / F.col("degree")).alias("share")).write.mode("overwrite").parquet(f"{base}/shares")
    nodes = graph.nodes.join(degrees.select("id", "targets"), "id", "left")
    nodes.select("id", F.coalesce("targets", F.lit(0)).alias("targets")).write.mode("overwrite").parquet(f"{base}/nodes")
    result = None
    for at in range(0, len(sources), SOURCES_PER_RUN):
        ranks = _log_run(spark, sources[at : at + SOURCES_PER_RUN], iterations, base, f"{base}/sources={at}")
        result = ranks if result is None else result.unionByName(ranks)
    return result.select("id", "source", F.col("rank").alias("log_score"))


def _log_run(spark: SparkSession, sources: Sequence[int], iterations: int, base: str, place: str) -> DataFrame:
    edges, nodes = spark.read.parquet(f"{base}/shares"), spark.read.parquet(f"{base}/nodes")
    starts = nodes.filter(F.col("id").isin(list(sources))).select("id", F.col("id").cast("long").alias("source"))
    starts.select("id", "source", F.lit(0.0).alias("rank")).write.mode("overwrite").parquet(_log_state_path(place, 0))
    for i in range(iterations):
        state = spark.read.parquet(_log_state_path(place, i)).join(nodes, "id")
        arrived = log_messages(edges, state)
        total = arrived.groupBy("source").agg(F.sum(F.exp("mass")).alias("held"))
        lost = F.greatest(F.lit(0.0), 1.0 - F.coalesce("held", F.lit(0.0)))
        back = starts.join(total, "source", "left").select("id", "source", F.ln((1.0 - JUMP) * lost + JUMP).alias("rank"))
        moved = arrived.select("id", "source", (F.col("mass") + F.lit(math.log(1.0 - JUMP))).alias("rank"))
        log_sums(moved.unionByName(back), ["id", "source"], "rank").write.mode("overwrite").parquet(_log_state_path(place, i + 1))
    return spark.read.parquet(_log_state_path(place, iterations))


def top_nodes(ranks: DataFrame, k: int, shards: int = TOP_SHARDS) -> DataFrame:
    """The ``k`` best nodes of every source; equal scores by ascending id.

    A source has a row for every node, so the best of each shard are found
    first: the last step sees at most ``shards * k`` rows per source.
    """
    order = [F.desc("score"), F.asc("id")]
    shard = F.pmod(F.xxhash64("id"), F.lit(shards))
    in_shard = Window.partitionBy("source", shard).orderBy(*order)
    overall = Window.partitionBy("source").orderBy(*order)
    return (
        ranks.withColumn("rank", F.row_number().over(in_shard))
        .filter(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(overall))
        .filter(F.col("rank") <= k)
        .select("source", "rank", "id", "score")
    )


def ranking_lines(top: DataFrame) -> DataFrame:
    """The rows of :func:`top_nodes` as ``score node`` lines, scores with five decimals."""
    return top.select("source", "rank", F.format_string("%.5f %d", "score", "id").alias("line"))


def parse_sources(text: str) -> list[int]:
    """A comma-separated list of node ids."""
    return [int(part) for part in text.split(",") if part.strip()]
