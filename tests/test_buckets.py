"""Bucketed tables: written, opened, written again; nothing stays in the catalog."""

from conftest import plan_of
from pyspark.sql import functions as F

from tallgrass.operators.buckets import bucket_session, buckets_for, read_buckets, schema_of, write_buckets


def test_joins_of_tables_with_the_same_buckets_need_no_shuffle(spark, tmp_path):
    place = str(tmp_path / "it's here")
    inner = bucket_session(spark, 6)
    rows = inner.range(300).select((F.col("id") % 40).alias("k"), "id")
    write_buckets(rows, f"{place}/a", "k", 6)
    write_buckets(rows.groupBy("k").agg(F.sum("id").alias("s")), f"{place}/b", "k", 6)
    a, b = (read_buckets(inner, f"{place}/{n}", "k", 6, schema_of(d)) for n, d in (("a", rows), ("b", rows.groupBy("k").agg(F.sum("id").alias("s")))))
    joined = a.join(b.hint("shuffle_hash"), "k").groupBy("k").agg(F.sum("id").alias("t"), F.max("s").alias("s"))
    assert "Exchange" not in plan_of(joined)
    assert joined.count() == 40 and joined.filter("t <> s").count() == 0
    assert not [t.name for t in inner.catalog.listTables() if t.name.startswith("tallgrass")]


def test_what_is_there_is_written_anew(spark, tmp_path):
    place, inner = str(tmp_path / "t"), bucket_session(spark, 3)
    for many in (50, 7):
        write_buckets(inner.range(many).withColumnRenamed("id", "k"), place, "k", 3)
        assert read_buckets(inner, place, "k", 3, "k bigint").count() == many


def test_an_empty_table(spark, tmp_path):
    inner = bucket_session(spark, 3)
    write_buckets(inner.range(0).withColumnRenamed("id", "k"), str(tmp_path / "t"), "k", 3)
    assert read_buckets(inner, str(tmp_path / "t"), "k", 3, "k bigint").count() == 0


def test_buckets_follow_the_bytes_and_settings_stay(spark, tmp_path):
    spark.range(10_000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    slots = spark.sparkContext.defaultParallelism
    assert buckets_for(table) == slots and buckets_for(table, 1000) > 40
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    assert bucket_session(spark, 77).conf.get("spark.sql.shuffle.partitions") == "77"
    assert before == (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled"))


def test_no_task_holds_its_rows_to_write_buckets(spark, tmp_path):
    inner = bucket_session(spark, 4)
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway

    def peaks():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).peakExecutionMemory() for i in range(found.size())}

    before = peaks()
    rows = inner.range(0, 400_000, 1, 4).selectExpr("id", "id * 2 AS n").repartition(4, "id")
    write_buckets(rows, str(tmp_path / "t"), "id", 4)
    assert max(n for stage, n in peaks().items() if stage not in before) < 1 << 20
    table = read_buckets(inner, str(tmp_path / "t"), "id", 4, schema_of(rows))
    assert table.count() == 400_000 and table.filter("n <> id * 2").isEmpty()
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 4
