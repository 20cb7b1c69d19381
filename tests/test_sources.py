import pytest

from tallgrass import session
from tallgrass.sources import records, sinks, tables, text


def values(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo words\n")
    assert [r.value for r in text.read_lines(spark, str(tmp_path / "a.txt")).collect()] == ["one", "", "two words"]


def test_lines_of_documents(spark):
    docs = spark.createDataFrame([(1, "a\n\nb"), (2, "")], "doc_id long, text string")
    assert [tuple(r) for r in text.lines_of(docs).orderBy("doc_id", "line_no").collect()] == [
        (1, 0, "a"), (1, 1, ""), (1, 2, "b"), (2, 0, ""),
    ]


def test_delimited_round_trip(spark):
    df = spark.createDataFrame([(1, "x y", 2.5, None), (2, 'say "hi"', 1e-9, "z")], "a long, b string, c double, d string")
    back = tables.parse_delimited(tables.format_delimited(df), "a long, b string, c double, d string")
    assert [tuple(r) for r in back.orderBy("a").collect()] == [(1, "x y", 2.5, None), (2, 'say "hi"', 1e-9, "z")]


def test_instances(spark):
    parsed = records.parse_instances(values(spark, "d1 spam 5 5 7", "d2 ham", "", "d3 ham 1 -2"))
    assert [tuple(r) for r in parsed.collect()] == [
        ("d1", "spam", [5, 5, 7]), ("d2", "ham", []), ("d3", "ham", [1, -2]),
    ]


def test_model_text_round_trip(spark):
    model = spark.createDataFrame([("m", 5, 0.25), ("m", -3, -1.5e-7)], "model_id string, feature int, weight double")
    back = records.parse_model(records.format_model(model), "m")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, model.collect()))
    kept = records.parse_model(values(spark, "junk", "(1,2", "(7,0.5)"), on_error="keep")
    assert [tuple(r) for r in kept.collect()] == [("0", None, None, "junk"), ("0", None, None, "(1,2"), ("0", 7, 0.5, None)]


@pytest.mark.parametrize(
    ("parse", "good", "bad"),
    [
        (records.parse_adjacency, "1 2 3", "1 2 x 3"), (records.parse_adjacency, "4", "q 2"),
        (records.parse_instances, "d ham 5", "d ham 5 x"), (records.parse_instances, "d ham", "d"),
        (records.parse_model, "(1,0.5)", "(x,0.5)"), (records.parse_trips, ",".join("012345678901"), "green,1"),
    ],
)
def test_bad_lines_raise_or_are_kept(spark, parse, good, bad):
    assert parse(values(spark, good, "", "  ")).count() == 1
    with pytest.raises(Exception, match="bad record"):
        parse(values(spark, good, bad)).collect()
    kept = parse(values(spark, good, bad), on_error="keep").collect()
    assert [r.bad_line for r in kept] == [None, bad]
    with pytest.raises(ValueError):
        parse(values(spark, good), on_error="drop")


def test_trips_choose_their_point_by_type(spark):
    green = ",".join(["green", *map(str, range(1, 12))])
    other = ",".join(["yellow", *map(str, range(1, 12))])
    got = records.parse_trips(values(spark, green, other)).collect()
    assert [tuple(r) for r in got] == [("green", 8.0, 9.0), ("yellow", 10.0, 11.0)]


def test_sorted_sink_splits_a_hot_first_key(spark, tmp_path):
    df = spark.range(4000).selectExpr("'the' as x", "id as y")
    sinks.save_sorted(df, str(tmp_path / "out"), ["x", "y"], files=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4000
    sizes = [r[0] for r in back.selectExpr("input_file_name() f").groupBy("f").count().select("count").collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
    sinks.save(df.limit(1), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    with pytest.raises(ValueError):
        sinks.save(df, str(tmp_path / "out"), "xml")


def test_state_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    place = session.new_run_dir(spark, "t")
    assert place != session.new_run_dir(spark, "t")
    if configured:
        assert place.startswith(configured.rstrip("/") + "/tallgrass-t-")


class FakeSession:
    class conf:
        @staticmethod
        def get(key, *default):
            return default[0] if default else "hdfs://place/warehouse"


def test_without_a_checkpoint_folder_state_lies_below_the_warehouse():
    assert session.shared_dir(FakeSession) == "hdfs://place/warehouse/tallgrass-state"


def test_widen_only_adds_partitions(spark):
    few = spark.range(0, 100, 1, 1)
    many = spark.range(0, 100, 1, 50)
    assert tables.widen(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert tables.widen(many, "id") is many
