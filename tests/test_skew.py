"""Task balance when one key holds a third of all rows or more."""

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import classifier, graph, index, words
from tallgrass.plans import relational

PARTS = 16
DATE = "1998-08-23"
SETTINGS = {
    "spark.sql.shuffle.partitions": str(PARTS),
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "false",
}


@pytest.fixture
def parts(spark, no_broadcast):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(spark, run, min_records=4000):
    """The largest part of a stage's shuffled records that one task reads."""
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway

    def stages():
        found = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return [found.apply(i) for i in range(found.size())]

    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    seen = {s.stageId() for s in stages()}
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    worst = 0.0
    for stage in stages():
        if stage.stageId() in seen or stage.numTasks() < PARTS:
            continue
        tasks = store.taskList(stage.stageId(), stage.attemptId(), 10_000)
        reads = [
            tasks.apply(i).taskMetrics().get().shuffleReadMetrics().recordsRead()
            for i in range(tasks.size())
            if tasks.apply(i).taskMetrics().isDefined()
        ]
        if sum(reads) >= min_records:
            worst = max(worst, max(reads) / sum(reads))
    assert worst > 0
    return worst


def check(spark, df):
    assert largest_share(spark, lambda: df.write.format("noop").mode("overwrite").save()) < 0.16


def hashed(seed, n):
    return F.abs(F.xxhash64(F.col("id"), F.lit(seed))) % n


def letters(number):
    return F.translate(number.cast("string"), "0123456789", "abcdefghij")


@pytest.fixture
def tokenized(spark):
    value = F.concat_ws(" ", F.lit("the"), letters(hashed(1, 20_000)), F.lit("the"), letters(hashed(2, 20_000)), F.lit("of"))
    return words.tokenized_lines(spark.range(0, 12_000, 1, 8).select(F.col("id").alias("doc_id"), value.alias("value")))


@pytest.mark.parametrize(
    "operator",
    [words.pmi_pairs, words.bigram_frequencies, lambda t: words.pmi_stripes(t, max_entries=100)],
    ids=["pmi", "bigrams", "stripes"],
)
def test_words(spark, parts, tokenized, operator):
    check(spark, operator(tokenized))


def test_index(spark, parts):
    docs = spark.range(0, 12_000, 1, 8).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("the of"), letters(hashed(3, 5000))).alias("text")
    )
    built = index.build_index(docs, docs_per_block=64)
    check(spark, built.postings)
    check(spark, index.boolean_search(built, "the of AND"))


def test_graph(spark, parts, monkeypatch):
    monkeypatch.setattr(graph, "buckets_for", lambda table: PARTS)
    third = F.col("id") % 3
    edges = spark.range(0, 60_000, 1, 8).select(
        F.when(third == 0, 0).when(third == 1, F.col("id") % 5000).otherwise(hashed(4, 5000)).alias("src"),
        F.when(third == 1, 7).otherwise(hashed(5, 5000)).alias("dst"),
    )
    built = graph.build_graph(spark.range(5000), edges)

    def run():
        graph.personalized_pagerank(built, [0, 7], 2, edges_per_block=100)

    assert largest_share(spark, run) < 0.16
    assert largest_share(spark, lambda: graph.log_pagerank(built, [0, 7], 2)) < 0.16


@pytest.fixture
def instances(spark):
    return spark.range(0, 6000, 1, 8).select(
        F.col("id").cast("string").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "spam").otherwise("ham").alias("label"),
        F.array(F.lit(1), F.lit(1), hashed(6, 3000).cast("int"), hashed(7, 3000).cast("int")).alias("features"),
    )


def test_classifier(spark, parts, instances, monkeypatch):
    monkeypatch.setattr(classifier, "buckets_for", lambda table: PARTS)
    model = spark.range(1, 2500).select(
        F.lit("a").alias("model_id"), F.col("id").cast("int").alias("feature"), F.lit(0.5).alias("weight")
    )
    check(spark, classifier.score(instances, model))
    assert largest_share(spark, lambda: classifier.train_epochs(instances, 1)) < 0.16


def test_reports(spark, parts):
    third = F.col("id") % 3
    lineitem = spark.range(0, 40_000, 1, 8).select(
        F.when(third == 2, 3).otherwise(hashed(8, 9000)).alias("l_orderkey"),
        F.when(third == 0, 1).otherwise(hashed(9, 3000)).alias("l_partkey"),
        F.when(third == 1, 1).otherwise(hashed(10, 3000)).alias("l_suppkey"),
        F.lit(DATE).cast("date").alias("l_shipdate"),
    )
    part = spark.range(3000).select(F.col("id").alias("p_partkey"), F.lit("p").alias("p_name"))
    supplier = spark.range(3000).select(F.col("id").alias("s_suppkey"), F.lit("s").alias("s_name"))
    orders = spark.range(9000).select(
        F.col("id").alias("o_orderkey"), F.when(third == 0, 1).otherwise(F.col("id") % 3000).alias("o_custkey"),
        F.lit("c").alias("o_clerk"),
    )
    customer = spark.range(3000).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).alias("c_nationkey"))
    nation = spark.range(25).select(F.col("id").alias("n_nationkey"), F.col("id").cast("string").alias("n_name"))
    check(spark, relational.q2(lineitem, orders.filter("o_orderkey > 500"), DATE))
    check(spark, relational.q3(lineitem, part, supplier, DATE))
    check(spark, relational.q4(lineitem, orders, customer, nation, DATE))
    check(spark, relational.q5(lineitem, orders, customer, nation, ["1", "2"]))
