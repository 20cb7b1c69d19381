"""The window counts of :mod:`tallgrass.operators.windows` over a file stream.

A job counts into its checkpointed state, one row per window and region, and
:func:`read_counts` reads the counts from there. There is no watermark and no sink:
files come in any order of event time, and every event counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallgrass.functions.regions import Region
from tallgrass.functions.times import to_instant, to_wall
from tallgrass.operators.windows import from_panes, locate
from tallgrass.sources.records import parse_trips

ALL_EVENTS = "all"  # fixed value: the key of a count over every event


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    glob: str = "part-*",
    fmt: str = "parquet",
    files_per_batch: int | None = 1,
) -> DataFrame:
    """Files of a folder as a stream, oldest first, a number of files per batch."""
    reader = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_trips(
    spark: SparkSession, path: str, start: str, files_per_batch: int | None = 1, step: str = "1 minute"
) -> DataFrame:
    """CSV trip files, one per ``step`` of time, as ``(ts, event_type, x, y)``.

    The number in a file name, ``part-<number>``, tells how many steps after ``start``
    its trips ended: the lines themselves have no time.
    """
    lines = stream_files(spark, path, "value string", fmt="text", files_per_batch=files_per_batch)
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    ts = F.lit(start).cast("timestamp_ntz") + F.expr(f"INTERVAL {step}") * number
    return parse_trips(lines.select(ts.alias("ts"), "value"))


def with_event_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Read a ``timestamp_ntz`` column as UTC: a watermark needs an instant."""
    if not isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        return events
    return events.withColumn(ts, to_instant(F.col(ts)))


def count_windows(events: DataFrame, size: str, regions: Sequence[Region] | None = None) -> DataFrame:
    """Streaming counts per window, and per region if regions are given.

    There is no watermark: files come in any order of event time, and no event
    is too late to count. The state has one row per window and region. For sliding
    windows count by the slide, and let :func:`read_counts` put the panes together.
    """
    timed = with_event_time(events)
    window = F.window("ts", size)
    if regions is None:
        grouped, region = timed.groupBy(window), F.lit(ALL_EVENTS).alias("region")
    else:
        grouped, region = locate(timed, regions).groupBy(window, "region"), F.col("region")
    return grouped.agg(F.count(F.lit(1)).alias("n")).select("window.start", "window.end", region, "n")


def start_job(counts: DataFrame, place: str, every: str | None = None) -> StreamingQuery:
    """Count into the state below ``place``, from where :func:`read_counts` takes the counts.

    The job stops when the files present are read, or with ``every`` runs on
    and takes new files at that interval. A later call with the same ``place``
    goes on where this one stopped.
    """
    writer = (
        counts.writeStream.format("noop")
        .option("checkpointLocation", f"{place}/checkpoint")
        .outputMode("update")
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_job(counts: DataFrame, place: str) -> None:
    start_job(counts, place).awaitTermination()


def read_counts(spark: SparkSession, place: str, panes: int = 1, slide: str | None = None) -> DataFrame:
    """``(window_start, window_end, region, n)`` over every event read so far.

    With ``panes``, windows of so many slides that start at every slide, from a job
    that counts by ``slide``: an event is in the state once, however many windows hold it.
    """
    state = spark.read.format("statestore").load(f"{place}/checkpoint")
    by_region = "region" in state.schema["key"].dataType.names
    counts = state.select(
        to_wall(F.col("key.window.start")).alias("window_start"),
        to_wall(F.col("key.window.end")).alias("window_end"),
        (F.col("key.region") if by_region else F.lit(ALL_EVENTS)).alias("region"),
        F.col("value.count").alias("n"),
    )
    return counts if panes == 1 else from_panes(counts, panes, slide, ["region"])
