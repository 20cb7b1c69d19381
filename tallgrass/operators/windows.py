"""Event counts per time window and region, zero rows and trend alerts, in batch.

Times are ``timestamp_ntz``. A window is ``[start, end)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.functions.regions import Region, all_regions, first_region
from tallgrass.functions.times import to_instant

MIN_ARRIVALS = 10  # fixed value: fewest arrivals that can raise an alert
GROWTH = 2  # fixed value: growth over the window before that raises one
# Fixed value: the text of an alert.
ALERT = "Number of arrivals to %s has doubled from %d to %d at %d!"
FILL = 1000


def choose_point(
    events: DataFrame, type_col: str, chosen: str, point: tuple[str, str], other: tuple[str, str]
) -> DataFrame:
    """Add ``x`` and ``y`` from ``point`` for records of one type, from ``other`` for the rest."""
    is_chosen = F.col(type_col) == chosen
    return events.withColumns(
        {
            "x": F.when(is_chosen, F.col(point[0])).otherwise(F.col(other[0])),
            "y": F.when(is_chosen, F.col(point[1])).otherwise(F.col(other[1])),
        }
    )


def locate(events: DataFrame, regions: Sequence[Region]) -> DataFrame:
    """Events inside a region, with the name of the first one that matches."""
    named = events.withColumn("region", first_region(F.col("x"), F.col("y"), regions))
    return named.filter("region is not null")


def locate_all(events: DataFrame, regions: Sequence[Region]) -> DataFrame:
    """A row per event and region that holds it: regions may overlap."""
    return events.withColumn("region", F.explode(all_regions(F.col("x"), F.col("y"), regions)))


def locate_in(events: DataFrame, regions: DataFrame, cell: float, spread: int = 16) -> DataFrame:
    """A row per event and region of a table ``(region, x_min, x_max, y_min, y_max)`` that holds it.

    Regions are cut into square cells, and events meet those of their own cell. A region
    of any size works, but has a record for each of its cells: choose ``cell`` near the
    usual size of a region. Events of one cell go to ``spread`` tasks, each with a copy
    of the cell's regions. Events without coordinates are in no region. A region with a
    null or infinite bound raises: it would have no end of cells.
    """
    bounds = ["x_min", "x_max", "y_min", "y_max"]
    endless = F.coalesce(F.greatest(*[F.abs(F.col(b).cast("double")) for b in bounds]), F.lit(float("inf"))) >= float("inf")
    for b in bounds:
        endless = endless | F.col(b).isNull() | F.isnan(F.col(b).cast("double"))
    refused = F.raise_error(F.concat(F.lit("region without bounds: "), F.coalesce(F.col("region").cast("string"), F.lit("null"))))
    # Each bound carries the check, so that no filter on one of them goes first.
    regions = regions.withColumns({b: F.when(endless, refused.cast("double")).otherwise(F.col(b).cast("double")) for b in bounds})

    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))

    cells = (
        regions.filter("x_min < x_max and y_min < y_max")
        .select("region", "x_min", "x_max", "y_min", "y_max", F.explode(span("x_min", "x_max")).alias("_cx"))
        .withColumn("_cy", F.explode(span("y_min", "y_max")))
        .withColumn("_turn", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    )
    placed = events.withColumns({
        "_cx": F.floor(F.col("x") / cell),
        "_cy": F.floor(F.col("y") / cell),
        "_turn": F.pmod(F.xxhash64(*events.columns), F.lit(spread)).cast("int"),
    })
    inside = (F.col("x") > F.col("x_min")) & (F.col("x") < F.col("x_max")) & (F.col("y") > F.col("y_min")) & (F.col("y") < F.col("y_max"))
    return placed.join(cells, ["_cx", "_cy", "_turn"]).filter(inside).select(*events.columns, "region")


def counts_in(events: DataFrame, regions: DataFrame, cell: float, spread: int = 16) -> DataFrame:
    """``(region, n)``: how many events each region of a table holds; regions without any have no row.

    As :func:`locate_in`, but events at one point and regions of one shape meet once: the
    work follows from the different points and shapes, not from events times regions.
    """
    bounds = ["x_min", "x_max", "y_min", "y_max"]
    named = regions.select("region", F.struct(*[F.col(b).cast("double").alias(b) for b in bounds]).alias("shape"))
    shapes = named.groupBy("shape").agg(F.min("region").alias("name")).select(F.struct("name", "shape").alias("region"), "shape.*")
    points = events.filter("x is not null and y is not null").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    held = locate_in(points, shapes, cell, spread).groupBy(F.col("region.shape").alias("shape")).agg(F.sum("n").alias("n"))
    return named.join(held, "shape").groupBy("region").agg(F.sum("n").alias("n"))


def _ends(window: str = "w") -> list[Column]:
    return [F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end")]


def window_counts(events: DataFrame, size: str, by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """``(window_start, window_end, *by, n)`` over tumbling windows."""
    return (
        events.groupBy(F.window(ts, size).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*_ends(), *by, "n")
    )


def sliding_counts(
    events: DataFrame, panes: int, slide: str, by: Sequence[str] = (), ts: str = "ts"
) -> DataFrame:
    """Counts over windows of ``panes`` slides that start at every slide.

    Events are counted once per slide. Only those counts, not the events, are
    then repeated for the windows that share them.
    """
    return from_panes(window_counts(events, slide, by, ts), panes, slide, by)


def from_panes(counts: DataFrame, panes: int, slide: str, by: Sequence[str] = ()) -> DataFrame:
    """Windows of ``panes`` slides from the counts ``(window_start, *by, n)`` of each slide."""
    shift = F.explode(F.sequence(F.lit(0), F.lit(panes - 1))).alias("k")
    step = F.expr(f"INTERVAL {slide}")
    spread = counts.select("window_start", *by, "n", shift)
    return (
        spread.withColumn("window_start", F.col("window_start") - step * F.col("k"))
        .groupBy("window_start", *by)
        .agg(F.sum("n").alias("n"))
        .select("window_start", (F.col("window_start") + step * F.lit(panes)).alias("window_end"), *by, "n")
    )


def zero_fill(counts: DataFrame, size: str, last_end: Column) -> DataFrame:
    """Add windows without events: from the first one of a region up to ``last_end``.

    The windows of a region are listed span by span of ``FILL`` windows, so no row holds them all.
    """
    step = F.expr(f"INTERVAL {size}")
    first = counts.groupBy("region").agg(F.min("window_end").alias("first"))
    starts = F.explode(F.sequence("first", last_end, step * FILL)).alias("from")
    spans = first.select("region", starts).repartition("region", "from")
    until = F.least(last_end, F.col("from") + step * (FILL - 1))
    spine = spans.select("region", F.explode(F.sequence("from", until, step)).alias("window_end"))
    return spine.join(counts.select("region", "window_end", "n"), ["region", "window_end"], "left").select(
        (F.col("window_end") - step).alias("window_start"),
        "window_end",
        "region",
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def last_window_end(events: DataFrame, size: str, ts: str = "ts") -> Column:
    """End of the window that holds the latest event."""
    latest = events.agg(F.max(ts).alias("_t")).select(F.window("_t", size).alias("w"))
    return latest.select("w.end").scalar()


def trending(
    filled: DataFrame,
    regions: Sequence[Region],
    min_arrivals: int = MIN_ARRIVALS,
    growth: int = GROWTH,
) -> DataFrame:
    """``(region, window_end, current, previous, is_trending, message)``.

    ``filled`` holds consecutive windows of a region, so the window before is
    found by an equality of times. A region's first window has 0 before it.
    """
    before = filled.select(
        "region", F.col("window_end").alias("window_start"), F.col("n").alias("previous")
    )
    compared = filled.join(before, ["region", "window_start"], "left").select(
        "region", "window_end", F.col("n").alias("current"), F.coalesce("previous", F.lit(0)).alias("previous")
    )
    alert = (F.col("current") >= min_arrivals) & (F.col("current") >= F.col("previous") * growth)
    title = F.coalesce(*[F.when(F.col("region") == r.name, F.lit(r.title or r.name)) for r in regions])
    at = F.unix_millis(to_instant(F.col("window_end")))
    text = F.format_string(ALERT, title, "previous", "current", at)
    return compared.withColumn("is_trending", alert).withColumn("message", F.when(F.col("is_trending"), text))
