import datetime as dt
import re
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tallgrass.functions.regions import OFFICE_REGIONS, Region
from tallgrass.operators import windows

T0 = dt.datetime(2024, 1, 1)
BOX = Region("box", 0, 10, 0, 10, "The Box")
INNER = Region("inner", 2, 4, 2, 4)


def events(spark, rows):
    rows = [(t, float(x), float(y)) for t, x, y in rows]
    return spark.createDataFrame(rows, "ts timestamp_ntz, x double, y double")


def at(minutes, x=5.0, y=5.0):
    return (T0 + dt.timedelta(minutes=minutes), x, y)


def test_points_on_an_edge_are_outside(spark):
    points = [(0.0, 5.0), (10.0, 5.0), (5.0, 0.0), (5.0, 10.0), (0.001, 9.999)]
    found = windows.locate(events(spark, [at(0, x, y) for x, y in points]), [BOX])
    assert [(r.x, r.y) for r in found.collect()] == [(0.001, 9.999)]


def test_first_region_wins_and_all_regions_match(spark):
    df = events(spark, [at(0, 3, 3), at(0, 5, 5), at(0, 50, 50)])
    assert Counter(r.region for r in windows.locate(df, [INNER, BOX]).collect()) == {"inner": 1, "box": 1}
    assert Counter(r.region for r in windows.locate(df, [BOX, INNER]).collect()) == {"box": 2}
    assert Counter(r.region for r in windows.locate_all(df, [BOX, INNER]).collect()) == {"box": 2, "inner": 1}


def test_built_in_regions(spark):
    df = events(spark, [at(0, -74.0140, 40.7145), at(0, -74.011, 40.721), at(0, -74.013, 40.718)])
    assert [r.region for r in windows.locate(df, OFFICE_REGIONS).collect()] == ["goldman", "citigroup"]


def test_tumbling_and_sliding_counts(spark):
    minutes = [0, 1, 14, 15, 59, 60, 61, 119, 200]
    df = events(spark, [at(m) for m in minutes])
    hours = {r.window_start: r.n for r in windows.window_counts(df, "60 minutes").collect()}
    assert hours == Counter(T0 + dt.timedelta(hours=m // 60) for m in minutes)
    sliding = windows.sliding_counts(df, 4, "15 minutes")
    direct = df.groupBy(F.window("ts", "60 minutes", "15 minutes").alias("w")).count()
    assert {(r.window_start, r.window_end, r.n) for r in sliding.collect()} == {
        (r.w.start, r.w.end, r["count"]) for r in direct.collect()
    }


def filled_counts(spark, per_window):
    """One region, ten-minute windows, a number of events in each."""
    rows = [at(10 * i + 1) for i, n in enumerate(per_window) for _ in range(n)]
    df = events(spark, rows + [at(10 * len(per_window) - 1, 99, 99)])
    counts = windows.window_counts(windows.locate(df, [BOX]), "10 minutes", ["region"])
    return windows.zero_fill(counts, "10 minutes", windows.last_window_end(df, "10 minutes"))


def test_zero_rows_from_the_first_hit_to_the_end_of_all_events(spark):
    got = filled_counts(spark, [0, 3, 0, 0, 1, 0]).orderBy("window_end").collect()
    assert [r.n for r in got] == [3, 0, 0, 1, 0]
    assert got[0].window_start == T0 + dt.timedelta(minutes=10)


@pytest.mark.parametrize(
    "per_window, alerts",
    [
        ([9, 18, 35], [False, True, False]),
        ([10, 20, 40], [True, True, True]),
        ([10, 19, 0, 10], [True, False, False, True]),
        ([12, 0, 9], [True, False, False]),
    ],
)
def test_alerts(spark, per_window, alerts):
    got = windows.trending(filled_counts(spark, per_window), [BOX]).orderBy("window_end").collect()
    assert [r.is_trending for r in got] == alerts
    assert [r.previous for r in got] == [0] + per_window[:-1]


def test_alert_message(spark):
    row = windows.trending(filled_counts(spark, [10]), [BOX]).first()
    millis = int((T0 + dt.timedelta(minutes=10)).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert row.message == f"Number of arrivals to The Box has doubled from 0 to 10 at {millis}!"


def test_point_by_type(spark):
    df = spark.createDataFrame([("click", 1.0, 2.0), ("view", 1.0, 2.0)], "kind string, a double, b double")
    got = windows.choose_point(df, "kind", "click", ("a", "b"), ("b", "a")).collect()
    assert [(r.x, r.y) for r in got] == [(1.0, 2.0), (2.0, 1.0)]


def test_times_do_not_depend_on_the_session_zone(spark):
    wanted = windows.trending(filled_counts(spark, [10, 20]), [BOX]).collect()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert windows.trending(filled_counts(spark, [10, 20]), [BOX]).collect() == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_regions_of_a_table_equal_compiled_ones(spark, no_broadcast):
    boxes = [Region(f"r{i}", i % 7 - 3, i % 7 - 3 + (i % 5) * 1.5, i % 4 - 2.5, i % 4 + 3) for i in range(25)]
    points = [(i, (i * 37 % 140) / 10 - 6, (i * 53 % 120) / 10 - 6) for i in range(600)] + [(601, None, 1.0), (602, 1.0, None)] + [(603, 0.5, 0.5)] * 3
    events = spark.createDataFrame(points, "event_id long, x double, y double")
    table = spark.createDataFrame([(b.name, *map(float, b[1:5])) for b in boxes], "region string, x_min double, x_max double, y_min double, y_max double")
    found = windows.locate_in(events, table, 2.0)
    wanted = windows.locate_all(events, boxes)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert windows.locate_in(events.limit(0), table, 2.0).count() == windows.locate_in(events, table.limit(0), 2.0).count() == 0


@pytest.mark.parametrize("bounds", [(0.0, None, 0.0, 1.0), (0.0, float("inf"), 0.0, 1.0), (float("nan"), 1.0, 0.0, 1.0), (0.0, 1.0, float("-inf"), 1.0)])
def test_regions_without_an_end_raise(spark, bounds):
    schema = "region string, x_min double, x_max double, y_min double, y_max double"
    table = spark.createDataFrame([("ok", 0.0, 2.0, 0.0, 2.0), ("endless", *bounds)], schema)
    events = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    with pytest.raises(Exception, match="region without bounds: endless"):
        windows.locate_in(events, table, 2.0).collect()


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_zero_rows_do_not_depend_on_the_span_they_are_listed_in(spark, monkeypatch, span):
    monkeypatch.setattr(windows, "FILL", span)
    at = lambda m: dt.datetime(2024, 3, 10) + dt.timedelta(minutes=m)
    counts = spark.createDataFrame([(at(0), at(10), "a", 2), (at(40), at(50), "b", 1)], "window_start timestamp_ntz, window_end timestamp_ntz, region string, n long")
    end = F.lit(at(80)).cast("timestamp_ntz")
    found = {(r.region, r.window_end): r.n for r in windows.zero_fill(counts, "10 minutes", end).collect()}
    wanted = {("a", at(m)): 2 * (m == 10) for m in range(10, 90, 10)} | {("b", at(m)): int(m == 50) for m in range(50, 90, 10)}
    assert found == wanted


def test_regions_of_one_shape_meet_an_event_once(spark):
    """Counts as of :func:`locate_in`, though 2,000 regions of one shape hold 3,000 events at one point: few rows meet."""
    boxes = [("a", 0.0, 2.0, 0.0, 2.0), ("a", 1.0, 5.0, -1.0, 2.5), ("b", 0.0, 2.0, 0.0, 2.0), ("empty", 3.0, 3.0, 0.0, 1.0), ("far", 50.0, 51.0, 0.0, 1.0)]
    schema = "region string, x_min double, x_max double, y_min double, y_max double"
    events = spark.createDataFrame([((i * 37 % 140) / 10 - 6, (i * 53 % 120) / 10 - 6) for i in range(600)] + [(None, 1.0), (1.0, None), (0.0, 1.0)], "x double, y double")
    found = windows.counts_in(events, spark.createDataFrame(boxes, schema), 2.0)
    wanted = windows.locate_in(events, spark.createDataFrame(boxes, schema), 2.0).groupBy("region").count()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    same = spark.range(2000).selectExpr("cast(id as string) region", "0.0D x_min", "2.0D x_max", "0.0D y_min", "2.0D y_max")
    crowd = spark.range(3000).selectExpr("1.0D x", "1.0D y")
    counted = windows.counts_in(crowd, same, 2.0)
    assert {r.n for r in counted.collect()} == {3000} and counted.count() == 2000
    endless = spark.createDataFrame([("endless", 0.0, None, 0.0, 1.0)], schema)
    with pytest.raises(Exception, match="region without bounds: .endless"):
        windows.counts_in(events, endless, 2.0).collect()


def test_the_table_of_regions_meets_points_and_shapes(spark):
    from conftest import SMALL
    from tallgrass.plans import queries

    plan = plan_of(queries.region_table_matches(spark, SMALL))
    assert re.search(r"HashAggregate\(keys=\[(x#\d+|knownfloatingpoint.*?x#\d+).*y#", plan), plan
