import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallgrass.functions.regions import OFFICE_REGIONS, Region
from tallgrass.operators import windows
from tallgrass.streaming import jobs

T0 = dt.datetime(2024, 3, 10)
BOX = Region("box", 0, 10, 0, 10)
SCHEMA = "ts timestamp_ntz, x double, y double"


def put(spark, folder, name, minutes):
    """One file with an event per minute; later names have later file times."""
    rows = [(T0 + dt.timedelta(minutes=m), float(m % 20), 5.0) for m in minutes]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/w")
    written = next(f for f in os.listdir(f"{folder}/w") if f.endswith(".parquet"))
    with open(f"{folder}/w/{written}", "rb") as source, open(f"{folder}/in/{name}", "wb") as target:
        target.write(source.read())
    stamp = 1_700_000_000 + int(name.split("-")[1].split(".")[0])
    os.utime(f"{folder}/in/{name}", (stamp, stamp))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return str(tmp_path)


def rows_of(df):
    return sorted((r.window_start, r.window_end, r.region, r.n) for r in df.collect())


def batch(spark, folder, regions=None):
    df = spark.read.schema(SCHEMA).parquet(f"{folder}/in")
    if regions:
        return windows.window_counts(windows.locate(df, regions), "60 minutes", ["region"])
    return windows.window_counts(df, "60 minutes").selectExpr("window_start", "window_end", "'all' region", "n")


@pytest.mark.parametrize("regions", [None, [BOX]])
def test_stream_equals_batch_and_goes_on_after_a_stop(spark, folder, regions):
    put(spark, folder, "part-1.parquet", range(0, 100))
    put(spark, folder, "part-2.parquet", range(90, 240, 2))
    put(spark, folder, "other-3.parquet", range(0, 10))
    os.remove(f"{folder}/in/other-3.parquet")

    def run():
        stream = jobs.stream_files(spark, f"{folder}/in", SCHEMA)
        jobs.run_job(jobs.count_windows(stream, "60 minutes", regions), f"{folder}/job")
        return jobs.read_counts(spark, f"{folder}/job")

    assert rows_of(run()) == rows_of(batch(spark, folder, regions))
    put(spark, folder, "part-4.parquet", range(240, 400))
    assert rows_of(run()) == rows_of(batch(spark, folder, regions))


def test_no_event_is_too_late(spark, folder):
    for part in range(5):
        put(spark, folder, f"part-{part}.parquet", range(part, 5000, 5))
    stream = jobs.stream_files(spark, f"{folder}/in", SCHEMA)
    jobs.run_job(jobs.count_windows(stream, "60 minutes"), f"{folder}/job")
    assert sum(r.n for r in jobs.read_counts(spark, f"{folder}/job").collect()) == 5000


def test_only_part_files_are_read(spark, folder):
    put(spark, folder, "part-1.parquet", range(0, 30))
    put(spark, folder, "extra-2.parquet", range(0, 30))
    stream = jobs.stream_files(spark, f"{folder}/in", SCHEMA)
    jobs.run_job(jobs.count_windows(stream, "60 minutes"), f"{folder}/job")
    assert [r.n for r in jobs.read_counts(spark, f"{folder}/job").collect()] == [30]


def test_sliding_windows(spark, folder):
    put(spark, folder, "part-1.parquet", range(0, 200, 3))
    stream = jobs.stream_files(spark, f"{folder}/in", SCHEMA)
    jobs.run_job(jobs.count_windows(stream, "15 minutes"), f"{folder}/job")
    got = {(r.window_start, r.n) for r in jobs.read_counts(spark, f"{folder}/job", 4, "15 minutes").collect()}
    assert jobs.read_counts(spark, f"{folder}/job").count() == 14  # one row of state per slide of 200 minutes
    df = spark.read.schema(SCHEMA).parquet(f"{folder}/in")
    assert got == {(r.window_start, r.n) for r in windows.sliding_counts(df, 4, "15 minutes").collect()}


def test_window_times_do_not_depend_on_the_session_zone(spark, folder):
    put(spark, folder, "part-1.parquet", range(0, 300, 7))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = jobs.stream_files(spark, f"{folder}/in", SCHEMA)
        jobs.run_job(jobs.count_windows(stream, "60 minutes"), f"{folder}/job")
        assert rows_of(jobs.read_counts(spark, f"{folder}/job")) == rows_of(batch(spark, folder))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_missing_folder_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        jobs.stream_files(spark, str(tmp_path / "absent"), SCHEMA)


def test_trip_files_give_alerts_per_region(spark, folder):
    inside = {"goldman": ("-74.0140", "40.7145"), "citigroup": ("-74.011", "40.721")}
    arrivals = {"goldman": [4, 10, 9, 18, 0], "citigroup": [0, 3, 12, 30, 60]}

    def line(kind, x, y):
        fields = ["0"] * 12
        at = 8 if kind == "green" else 10
        fields[0], fields[at], fields[at + 1] = kind, x, y
        return ",".join(fields)

    for minute in range(50):
        found = [line("green", "0", "0")]
        if minute % 10 == 3:
            for region, counts in arrivals.items():
                found += [line("green" if i % 2 else "yellow", *inside[region]) for i in range(counts[minute // 10])]
        with open(f"{folder}/in/part-{minute:05d}", "w") as out:
            out.write("\n".join(found) + "\n")
        os.utime(f"{folder}/in/part-{minute:05d}", (1_700_000_000 + minute,) * 2)

    def trips():
        return jobs.stream_trips(spark, f"{folder}/in", "2024-03-10 00:00:00", files_per_batch=20)

    jobs.run_job(jobs.count_windows(trips(), "10 minutes"), f"{folder}/all")
    jobs.run_job(jobs.count_windows(trips(), "10 minutes", OFFICE_REGIONS), f"{folder}/regions")
    totals = {r.window_start: r.n for r in jobs.read_counts(spark, f"{folder}/all").collect()}
    starts = [T0 + dt.timedelta(minutes=10 * i) for i in range(5)]
    assert totals == {s: 10 + sum(c[i] for c in arrivals.values()) for i, s in enumerate(starts)}
    end = F.lit(starts[-1] + dt.timedelta(minutes=10)).cast("timestamp_ntz")
    filled = windows.zero_fill(jobs.read_counts(spark, f"{folder}/regions"), "10 minutes", end)
    alerts = windows.trending(filled, OFFICE_REGIONS).filter("is_trending").collect()
    assert sorted((r.region, r.previous, r.current) for r in alerts) == [
        ("citigroup", 3, 12), ("citigroup", 12, 30), ("citigroup", 30, 60), ("goldman", 4, 10), ("goldman", 9, 18),
    ]
    assert any(m.startswith("Number of arrivals to Goldman Sachs has doubled from 4 to 10 at ") for m in (r.message for r in alerts))


def test_a_job_can_run_on(spark, folder):
    put(spark, folder, "part-1.parquet", range(0, 60))
    stream = jobs.stream_files(spark, f"{folder}/in", SCHEMA)
    job = jobs.start_job(jobs.count_windows(stream, "60 minutes"), f"{folder}/job", every="1 second")
    try:
        job.processAllAvailable()
        assert job.isActive
    finally:
        job.stop()
    assert [r.n for r in jobs.read_counts(spark, f"{folder}/job").collect()] == [60]
