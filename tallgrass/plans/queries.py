"""The registered queries: operators bound to the tables of a data folder.

Every query reads whole tables. Doubles are rounded and nested values are
flattened, so that results can be compared with SQL.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallgrass.functions.regions import Region
from tallgrass.functions.tokens import explode_once, tokenize
from tallgrass.operators import classifier, graph, index, windows, words
from tallgrass.operators.buckets import estimated_bytes
from tallgrass.plans import relational
from tallgrass.session import new_run_dir
from tallgrass.sources import records
from tallgrass.sources.sinks import save
from tallgrass.sources.tables import TEXT_SCHEMAS, format_delimited, load_table, parse_delimited, widen
from tallgrass.sources.text import lines_of
from tallgrass.streaming import jobs

SHIP_DATE = "1998-08-23"
NATIONS = ("NATION_3", "NATION_24")
PMI_THRESHOLD = 10
SEARCH_AND = "the and AND"
SEARCH_OR = "avec der OR"
SEARCH_NESTED = "the and AND une OR"
INDEX_FILES = 8
SOURCES = (1, 2, 3)
SOURCE_LIST = "1, 2, 3"
GRAPH_PARTS = 8
EPOCHS = 3
BATCHES = 5
SEED = 17
PIECE_BYTES = 8 << 20
MODEL_FACTORS = (7, 11, 13)
BOXES = (Region("box_a", 10, 20, 20, 60, "Box A"), Region("box_b", 30, 60, 50, 90, "Box B"))
REGION_CELL = 5.0
HOUR = "60 minutes"
TREND_WINDOW = "6 hours"
SLIDE = "15 minutes"
PANES = 4

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---- relational reports ----


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [load_table(spark, sf_dir, name) for name in names]


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    # Adding zero turns a negative zero into a plain one.
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


PRICE_COLUMNS = (
    "sum_qty", "sum_base_price", "sum_disc_price", "sum_charge", "avg_qty", "avg_price", "avg_disc",
)


@query
def q1_count_shipdate(spark, sf_dir):
    return relational.q1(*_tables(spark, sf_dir, "lineitem"), SHIP_DATE)


@query
def q2_orders_on_date(spark, sf_dir):
    return relational.q2(*_tables(spark, sf_dir, "lineitem", "orders"), SHIP_DATE, "o_orderpriority")


@query
def q3_parts_suppliers(spark, sf_dir):
    return relational.q3(*_tables(spark, sf_dir, "lineitem", "part", "supplier"), SHIP_DATE)


@query
def q4_shipments_by_nation(spark, sf_dir):
    return relational.q4(*_tables(spark, sf_dir, "lineitem", "orders", "customer", "nation"), SHIP_DATE)


@query
def q5_shipments_by_month(spark, sf_dir):
    return relational.q5(*_tables(spark, sf_dir, "lineitem", "orders", "customer", "nation"), NATIONS)


@query
def q6_pricing_summary(spark, sf_dir):
    (lineitem,) = _tables(spark, sf_dir, "lineitem")
    return _rounded(relational.q6(lineitem, SHIP_DATE), 4, *PRICE_COLUMNS)


@query
def q6_from_text(spark, sf_dir):
    """The same report after a trip through delimited text lines."""
    (lineitem,) = _tables(spark, sf_dir, "lineitem")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lineitem.schema)
    lines = format_delimited(widen(lineitem, "l_orderkey", "l_linenumber"))
    parsed = parse_delimited(lines, schema)
    return _rounded(relational.q6(parsed, SHIP_DATE), 4, *PRICE_COLUMNS)


def _text_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Tables written as ``|``-delimited files of the fixed layout, and loaded from them.

    Columns that the given tables lack are empty.
    """
    place = new_run_dir(spark, "text")
    for name in names:
        table = load_table(spark, sf_dir, name)
        layout = StructType.fromDDL(TEXT_SCHEMAS[name])
        columns = [F.col(f.name).cast(f.dataType) if f.name in table.columns else F.lit(None).cast(f.dataType) for f in layout]
        filled = table.select(*[c.alias(f.name) for c, f in zip(columns, layout)])
        format_delimited(filled).write.text(f"{place}/{name}.tbl")
    return [load_table(spark, place, name, fmt="text") for name in names]


@query
def q1_text_files(spark, sf_dir):
    return relational.q1(*_text_tables(spark, sf_dir, "lineitem"), SHIP_DATE)


@query
def q2_text_files(spark, sf_dir):
    return relational.q2(*_text_tables(spark, sf_dir, "lineitem", "orders"), SHIP_DATE, "o_orderpriority")


@query
def q3_text_files(spark, sf_dir):
    return relational.q3(*_text_tables(spark, sf_dir, "lineitem", "part", "supplier"), SHIP_DATE)


@query
def q4_text_files(spark, sf_dir):
    return relational.q4(*_text_tables(spark, sf_dir, "lineitem", "orders", "customer", "nation"), SHIP_DATE)


@query
def q5_text_files(spark, sf_dir):
    return relational.q5(*_text_tables(spark, sf_dir, "lineitem", "orders", "customer", "nation"), NATIONS)


@query
def q6_text_files(spark, sf_dir):
    (lineitem,) = _text_tables(spark, sf_dir, "lineitem")
    return _rounded(relational.q6(lineitem, SHIP_DATE), 4, *PRICE_COLUMNS)


# ---- words ----


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widen(load_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def _tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.tokenized_lines(lines_of(_docs(spark, sf_dir)))


@query
def tokens(spark, sf_dir):
    found = _tokenized(spark, sf_dir)
    return explode_once(found, F.col("tokens"), "pos", "token", keep=["doc_id", "line_no"])


@query
def line_counts(spark, sf_dir):
    return words.line_count(_tokenized(spark, sf_dir))


@query
def word_line_freq(spark, sf_dir):
    return words.word_line_counts(_tokenized(spark, sf_dir))


@query
def pair_counts(spark, sf_dir):
    return words.mirror(words.pair_counts(_tokenized(spark, sf_dir), PMI_THRESHOLD))


@query
def pmi_pairs(spark, sf_dir):
    return _rounded(words.pmi_pairs(_tokenized(spark, sf_dir), PMI_THRESHOLD), 6, "pmi")


@query
def pmi_stripes(spark, sf_dir):
    """Built as maps, compared entry by entry."""
    stripes = words.pmi_stripes(_tokenized(spark, sf_dir), PMI_THRESHOLD)
    entries = stripes.select("x", F.explode("stripe").alias("y", "value"))
    return _rounded(entries.select("x", "y", "value.pmi", "value.n"), 6, "pmi")


@query
def bigram_freq(spark, sf_dir):
    pairs = words.bigram_frequencies(_tokenized(spark, sf_dir))
    return _rounded(pairs, 9, "freq")


@query
def bigram_marginals(spark, sf_dir):
    return words.bigrams_with_marginals(_tokenized(spark, sf_dir))


@query
def bigram_stripes(spark, sf_dir):
    """Built as maps, compared entry by entry."""
    stripes = words.bigram_stripes(_tokenized(spark, sf_dir))
    return _rounded(stripes.select("x", F.explode("stripe").alias("y", "freq")), 9, "freq")


# ---- index and retrieval ----


def _index(spark: SparkSession, sf_dir: str) -> index.InvertedIndex:
    return index.build_index(_docs(spark, sf_dir))


def _joined(items: str, first: str) -> Column:
    pair = F.transform(items, lambda p: F.concat_ws(":", p[first].cast("string"), p["tf"].cast("string")))
    return F.array_join(pair, " ")


@query
def doc_tf(spark, sf_dir):
    return index.term_frequencies(_docs(spark, sf_dir))


@query
def doc_freq(spark, sf_dir):
    return _index(spark, sf_dir).terms


@query
def postings(spark, sf_dir):
    found = _index(spark, sf_dir).postings
    return found.select("term", "block", _joined("postings", "doc_id").alias("postings"))


@query
def postings_gaps(spark, sf_dir):
    encoded = index.gap_encode(_index(spark, sf_dir).postings)
    return encoded.select("term", "block", _joined("gaps", "gap").alias("gaps"))


@query
def postings_decoded(spark, sf_dir):
    return index.gap_decode(index.gap_encode(_index(spark, sf_dir).postings))


@query
def bool_and(spark, sf_dir):
    return index.boolean_search(_index(spark, sf_dir), SEARCH_AND)


@query
def bool_or(spark, sf_dir):
    return index.boolean_search(_index(spark, sf_dir), SEARCH_OR)


@query
def bool_nested(spark, sf_dir):
    return index.boolean_search(_index(spark, sf_dir), SEARCH_NESTED)


@query
def bool_nested_sets(spark, sf_dir):
    """The nested search as set operations."""
    ix = _index(spark, sf_dir)
    both = index.docs_and(index.docs_with(ix, "the"), index.docs_with(ix, "and"))
    return index.docs_or(both, index.docs_with(ix, "une")).orderBy("doc_id")


@query
def bool_snippets(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return index.search_snippets(index.build_index(docs), docs, SEARCH_NESTED)


def _stored_index(spark: SparkSession, sf_dir: str) -> index.InvertedIndex:
    return index.save_index(_index(spark, sf_dir), new_run_dir(spark, "index"), INDEX_FILES)


@query
def stored_doc_freq(spark, sf_dir):
    return _stored_index(spark, sf_dir).terms


@query
def stored_bool_nested(spark, sf_dir):
    """The nested search over a stored index: only row groups with its terms are read."""
    return index.boolean_search(_stored_index(spark, sf_dir), SEARCH_NESTED)


@query
def stored_bool_snippets(spark, sf_dir):
    return index.search_snippets(_stored_index(spark, sf_dir), _docs(spark, sf_dir), SEARCH_NESTED)


# ---- graph ----
# Nodes are the customer keys. Every line is an edge from its supplier key to
# its part key and one back. Part keys run higher than customer keys, so some
# edges lead to ids that are no node.


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))


def _edges(spark: SparkSession, sf_dir: str, both_ways: bool = True) -> DataFrame:
    lines = load_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"))
    return _both_ways(lines) if both_ways else lines


def _both_ways(edges: DataFrame) -> DataFrame:
    both = F.array(
        F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    return edges.select(F.explode(both).alias("e")).select("e.src", "e.dst")


def _graph(spark: SparkSession, sf_dir: str, both_ways: bool = True) -> graph.Graph:
    return graph.build_graph(_nodes(spark, sf_dir), _edges(spark, sf_dir, both_ways))


def _ppr(spark: SparkSession, sf_dir: str, iterations: int, both_ways: bool = True) -> DataFrame:
    stored = graph.save_graph(_graph(spark, sf_dir, both_ways), new_run_dir(spark, "graph"))
    return graph.personalized_pagerank(stored, SOURCES, iterations)


@query
def graph_stats(spark, sf_dir):
    return graph.graph_stats(_graph(spark, sf_dir, both_ways=False))


@query
def graph_orphans(spark, sf_dir):
    return graph.orphan_targets(_graph(spark, sf_dir))


@query
def adjacency_edges(spark, sf_dir):
    """Edges parsed from adjacency text: ``part supplier order`` for every line."""
    names = ("l_partkey", "l_suppkey", "l_orderkey")
    table = widen(load_table(spark, sf_dir, "lineitem").select(*names), *names)
    lines = table.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in names]).alias("value"))
    edges = graph.adjacency_edges(records.parse_adjacency(lines))
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


@query
def adjacency_bad_lines(spark, sf_dir):
    """Adjacency text with an order priority among the neighbours: lines that are no numbers stay, as they are."""
    table = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    third = F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(F.col("o_orderpriority"))
    lines = table.select(F.concat_ws(" ", F.col("o_orderkey").cast("string"), third).alias("value"))
    return records.parse_adjacency(lines, on_error="keep").filter("bad_line is not null").select("bad_line")


@query
def ppr_iter1(spark, sf_dir):
    return _rounded(_ppr(spark, sf_dir, 1), 9, "score")


@query
def ppr_iter5(spark, sf_dir):
    return _rounded(_ppr(spark, sf_dir, 5), 9, "score")


@query
def ppr_dangling(spark, sf_dir):
    """Edges one way only, so most nodes have none."""
    return _rounded(_ppr(spark, sf_dir, 3, both_ways=False), 9, "score")


@query
def ppr_top_nodes(spark, sf_dir):
    ranks = _rounded(_ppr(spark, sf_dir, 5), 9, "score")
    return graph.top_nodes(ranks, 10)


@query
def ppr_report(spark, sf_dir):
    """The best nodes as text lines."""
    ranks = _rounded(_ppr(spark, sf_dir, 5), 9, "score")
    return graph.ranking_lines(graph.top_nodes(ranks, 10))


@query
def ppr_from_adjacency(spark, sf_dir):
    """From adjacency text (an order and its customer's key) to ranks, stopped after two iterations and resumed."""
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = orders.select(F.concat_ws(" ", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("value"))
    parsed = graph.graph_from_adjacency(records.parse_adjacency(lines))
    base = new_run_dir(spark, "ranks")
    graph.save_graph(graph.partition_graph(parsed, GRAPH_PARTS), base)
    sources = graph.parse_sources(SOURCE_LIST)
    graph.start_state(graph.load_graph(spark, base), sources, base)
    graph.advance(graph.load_graph(spark, base), sources, base, 0, 2)
    graph.advance(graph.load_graph(spark, base), sources, base, 2, 4)
    return _rounded(graph.read_ranks(spark, sources, base, 4), 9, "score")


@query
def ppr_missing_mass(spark, sf_dir):
    base = new_run_dir(spark, "ranks")
    stored = graph.save_graph(_graph(spark, sf_dir), base)
    graph.start_state(stored, SOURCES, base)
    graph.advance(stored, SOURCES, base, 0, 2)
    return _rounded(graph.mass_totals(spark, SOURCES, base, 2), 9, "arrived", "missing")


@query
def ppr_counters(spark, sf_dir):
    """What was counted while each iteration was written: nodes, nodes with mass, mass per source."""
    base = new_run_dir(spark, "ranks")
    stored = graph.save_graph(_graph(spark, sf_dir), base)
    graph.start_state(stored, SOURCES, base)
    graph.advance(stored, SOURCES, base, 0, 3)
    return _rounded(graph.iteration_counters(spark, SOURCES, base), 9, "arrived", "missing")


@query
def ppr_log(spark, sf_dir):
    """Ranks whose masses are logarithms all the way."""
    stored = graph.save_graph(_graph(spark, sf_dir), new_run_dir(spark, "graph"))
    ranks = graph.log_pagerank(stored, SOURCES, 4)
    return _rounded(ranks.select("id", "source", F.exp("log_score").alias("score")), 9, "score")


# ---- classifier ----
# A token's feature is the first four hex digits of its md5, as a number.


def _hashed(docs: DataFrame) -> DataFrame:
    features = F.transform(
        tokenize("text"), lambda t: F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int")
    )
    return docs.select(*[c for c in docs.columns if c != "text"], features.alias("features"))


def _stored_features(spark: SparkSession, instances: DataFrame) -> DataFrame:
    """``instances``, written once for all that a query asks of them: tokens are found and hashed a single time."""
    place = new_run_dir(spark, "features")
    save(instances, place)
    return spark.read.parquet(place)


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("toxic") == 1, F.lit("spam")).otherwise(F.lit("ham"))
    return load_table(spark, sf_dir, "labels").select("doc_id", label.alias("label"))


def _pieces(spark: SparkSession, sf_dir: str) -> int:
    """How many tasks count features: their number grows with the files of ``documents``, so none grows with the input."""
    size = estimated_bytes(load_table(spark, sf_dir, "documents")) or 0
    return max(spark.sparkContext.defaultParallelism, -(-size // PIECE_BYTES))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have a label, in pieces of a bounded size; texts without one are not hashed."""
    found = _docs(spark, sf_dir).join(_labels(spark, sf_dir), "doc_id")
    return _hashed(found.repartition(_pieces(spark, sf_dir), "doc_id", "text"))


def _all_instances(spark: SparkSession, sf_dir: str, arrays: DataFrame) -> DataFrame:
    """Every document; those without a label count as ``ham``."""
    joined = arrays.join(_labels(spark, sf_dir), "doc_id", "left")
    return joined.withColumn("label", F.coalesce("label", F.lit("ham")))


def _models(spark: SparkSession, sf_dir: str, arrays: DataFrame) -> DataFrame:
    """Stored weights by a fixed formula on the features of labelled documents.

    They are multiples of 1/1024, so sums are exact in any order.
    """
    features = explode_once(arrays.join(_labels(spark, sf_dir), "doc_id"), F.col("features"), "feature").distinct()
    weights = F.array(
        *[
            F.struct(
                F.lit(f"m{k}").alias("model_id"),
                (((F.col("feature") * k) % 201 - 100) / 1024).alias("weight"),
            )
            for k in MODEL_FACTORS
        ]
    )
    place = new_run_dir(spark, "model")
    save(features.select("feature", F.explode(weights).alias("m")).select("m.model_id", "feature", "m.weight"), place)
    return spark.read.parquet(place)


@query
def features(spark, sf_dir):
    """Instances written as text lines and parsed again: occurrences per feature."""
    joined = F.array_join(F.transform("features", lambda f: f.cast("string")), " ")
    lines = _labelled(spark, sf_dir).select(
        F.concat_ws(" ", F.col("doc_id").cast("string"), "label", joined).alias("value")
    )
    parsed = records.parse_instances(lines).withColumn("doc_id", F.col("doc_id").cast("long"))
    return classifier.feature_counts(parsed, ["doc_id", "label"], "n", _pieces(spark, sf_dir))


@query
def train_epochs(spark, sf_dir):
    model = classifier.train_epochs(_labelled(spark, sf_dir), EPOCHS, pieces=_pieces(spark, sf_dir))
    return _rounded(model.select("feature", "weight"), 9, "weight")


@query
def train_batches(spark, sf_dir):
    """One pass in batches of a random order that the seed alone decides."""
    # Numbering reads its rows twice, for the ranges first.
    instances = _stored_features(spark, _labelled(spark, sf_dir))
    model = classifier.train_one_pass(instances, BATCHES, SEED, pieces=_pieces(spark, sf_dir))
    return _rounded(model.select("feature", "weight"), 9, "weight")


@query
def random_order(spark, sf_dir):
    """The place of every document in a random order of all."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id")
    return classifier.in_random_order(docs, SEED)


@query
def score_docs(spark, sf_dir):
    """One model, read back from its text form."""
    arrays = _stored_features(spark, _hashed(_docs(spark, sf_dir)))
    models = _models(spark, sf_dir, arrays).filter(F.col("model_id") == f"m{MODEL_FACTORS[0]}")
    parsed = records.parse_model(records.format_model(models), F.col("model_id"))
    return _rounded(classifier.score(_all_instances(spark, sf_dir, arrays), parsed), 6, "score")


@query
def ensemble_average(spark, sf_dir):
    arrays = _stored_features(spark, _hashed(_docs(spark, sf_dir)))
    scored = classifier.score_ensemble(_all_instances(spark, sf_dir, arrays), _models(spark, sf_dir, arrays), "average")
    return _rounded(scored, 6, "score")


@query
def ensemble_vote(spark, sf_dir):
    arrays = _stored_features(spark, _hashed(_docs(spark, sf_dir)))
    return classifier.score_ensemble(_all_instances(spark, sf_dir, arrays), _models(spark, sf_dir, arrays), "vote")


# ---- events ----


def _points(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select("ts", "event_type", F.col("value").alias("x"), k.alias("y"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(load_table(spark, sf_dir, "events"))


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _located_counts(spark: SparkSession, sf_dir: str, size: str) -> DataFrame:
    return windows.window_counts(windows.locate(_events(spark, sf_dir), BOXES), size, ["region"])


def _filled(events: DataFrame, counts: DataFrame) -> DataFrame:
    return windows.zero_fill(counts, TREND_WINDOW, windows.last_window_end(events, TREND_WINDOW))


@query
def event_counts(spark, sf_dir):
    events = load_table(spark, sf_dir, "events")
    counts = windows.window_counts(events, HOUR).withColumn("region", F.lit(jobs.ALL_EVENTS))
    return _as_text(counts, "window_start", "window_end")


@query
def region_counts(spark, sf_dir):
    return _as_text(_located_counts(spark, sf_dir, HOUR), "window_start", "window_end")


@query
def region_counts_by_type(spark, sf_dir):
    """Clicks are placed at (x, y), all other events at (y, x)."""
    raw = _events(spark, sf_dir).withColumnsRenamed({"x": "a", "y": "b"})
    points = windows.choose_point(raw, "event_type", "click", ("a", "b"), ("b", "a"))
    counts = windows.window_counts(windows.locate(points, BOXES), HOUR, ["region"])
    return _as_text(counts, "window_start", "window_end")


@query
def region_matches(spark, sf_dir):
    """Overlapping regions: an event counts in every one that holds it."""
    overlapping = (*BOXES, Region("box_c", 15, 45, 30, 80))
    found = windows.locate_all(_events(spark, sf_dir), overlapping)
    return found.groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query
def region_table_matches(spark, sf_dir):
    """Overlapping regions from a table: one for each supplier, placed by its key."""
    key = F.col("s_suppkey")
    x, y = (key * 7 % 90).cast("double"), (key * 13 % 80).cast("double")
    regions = load_table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("region"), x.alias("x_min"), (x + 3.5).alias("x_max"), y.alias("y_min"), (y + 12.5).alias("y_max")
    )
    return windows.counts_in(_events(spark, sf_dir), regions, REGION_CELL)


@query
def region_counts_zero_filled(spark, sf_dir):
    filled = _filled(_events(spark, sf_dir), _located_counts(spark, sf_dir, TREND_WINDOW))
    return _as_text(filled, "window_start", "window_end")


@query
def sliding_counts(spark, sf_dir):
    events = load_table(spark, sf_dir, "events")
    return _as_text(windows.sliding_counts(events, PANES, SLIDE), "window_start", "window_end")


@query
def trending(spark, sf_dir):
    filled = _filled(_events(spark, sf_dir), _located_counts(spark, sf_dir, TREND_WINDOW))
    return _as_text(windows.trending(filled, BOXES), "window_end")


STREAM_FILES = 8
TRIP_FILES = 8


def _streamed(spark: SparkSession, sf_dir: str, size: str, regions=None) -> DataFrame:
    """Events dealt into files that overlap in time, one file per batch.

    The job stops when half of the files are there, and goes on with the rest.
    """
    events = load_table(spark, sf_dir, "events")
    files, place = new_run_dir(spark, "files"), new_run_dir(spark, "stream")
    dealt = events.withColumn("dealt", F.pmod("event_id", F.lit(STREAM_FILES)).cast("int"))
    for first in (0, STREAM_FILES // 2):
        half = dealt.filter(F.col("dealt").between(first, first + STREAM_FILES // 2 - 1))
        half.repartition("dealt").write.mode("append").partitionBy("dealt").parquet(files)
        stream = _points(jobs.stream_files(spark, files, dealt.schema))
        jobs.run_job(jobs.count_windows(stream, size, regions), place)
    return jobs.read_counts(spark, place)


def _stream_place(spark: SparkSession, sf_dir: str, size: str) -> str:
    """A finished job over one folder of event files."""
    files, place = new_run_dir(spark, "files"), new_run_dir(spark, "stream")
    events = load_table(spark, sf_dir, "events")
    events.repartition(STREAM_FILES, "event_id").write.parquet(files)
    stream = jobs.stream_files(spark, files, events.schema, files_per_batch=2)
    jobs.run_job(jobs.count_windows(stream, size), place)
    return place


@query
def stream_sliding_counts(spark, sf_dir):
    """Sliding windows of a stream whose state has one row per slide."""
    counts = jobs.read_counts(spark, _stream_place(spark, sf_dir, SLIDE), PANES, SLIDE)
    return _as_text(counts.drop("region"), "window_start", "window_end")


@query
def stream_trip_counts(spark, sf_dir):
    """Events as CSV trips, one file per day with the day's number in its name, and counted by region from there.

    Clicks are green trips, with the point in fields 8 and 9; all others have it in
    fields 10 and 11. In either case the other two fields hold the point turned round.
    """
    events = _points(load_table(spark, sf_dir, "events"))
    days = events.agg(F.min(F.to_date("ts")).alias("first"), F.datediff(F.max("ts"), F.min("ts")).alias("span")).first()
    first, many = days["first"] or datetime.date(1970, 1, 1), (days["span"] or 0) + 1
    green = F.col("event_type") == "click"
    x, y = F.col("x").cast("string"), F.col("y").cast("string")
    early, late = F.when(green, x).otherwise(y), F.when(green, y).otherwise(x)
    kind = F.when(green, "green").otherwise("yellow")
    empty = [F.lit("") for _ in range(7)]
    line = F.concat_ws(",", kind, *empty, early, late, F.when(green, y).otherwise(x), F.when(green, x).otherwise(y))
    files, place = new_run_dir(spark, "trips"), new_run_dir(spark, "stream")
    number = F.datediff(F.to_date("ts"), F.lit(first)).cast("int")
    events.filter("x is not null and y is not null").repartitionById(many, number).select(line.alias("value")).write.text(files)
    trips = jobs.stream_trips(spark, files, str(first), TRIP_FILES, "1 day")
    jobs.run_job(jobs.count_windows(trips, "1 day", BOXES), place)
    return _as_text(jobs.read_counts(spark, place), "window_start", "window_end")


@query
def stream_event_counts(spark, sf_dir):
    return _as_text(_streamed(spark, sf_dir, HOUR), "window_start", "window_end")


@query
def stream_region_counts(spark, sf_dir):
    return _as_text(_streamed(spark, sf_dir, HOUR, BOXES), "window_start", "window_end")


@query
def stream_trending(spark, sf_dir):
    counts = _streamed(spark, sf_dir, TREND_WINDOW, BOXES)
    return _as_text(windows.trending(_filled(_events(spark, sf_dir), counts), BOXES), "window_end")
