"""Dense row numbers in a given order: no task sees more than its share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallgrass.session import new_run_dir

_ROWS_BITS = 33  # fixed value: row bits of monotonically_increasing_id, below the partition's number


def numbered(rows: DataFrame, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``_index``, from 0 in each group of ``within``, and ``_total``, the rows of the group.

    ``order`` are columns, ascending, nulls first, with those of ``within`` in front of
    it; rows that tie in all of them are numbered in any order. ``within`` columns must
    not be null. Rows are dealt by ranges and written once to the shared folder, so that
    every later step sees the same ranges; what is gathered then is one count for each
    range and group.
    """
    spark = rows.sparkSession
    keys = [*within, *order]
    place = new_run_dir(spark, "numbered")
    # A hash of the position spreads repeated rows over several ranges.
    spread = rows.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    ranged = spread.repartitionByRange(*keys, "_spread").sortWithinPartitions(*keys).drop("_spread")
    ranged.withColumn("_place", F.monotonically_increasing_id()).write.parquet(place)
    placed = spark.read.parquet(place).withColumn("_part", F.shiftright("_place", _ROWS_BITS))
    counts = placed.groupBy(*within, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    before = F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        *within, "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(group).alias("_total")
    )
    found = placed.join(starts, [*within, "_part"])
    return found.select(*rows.columns, (F.col("_place") + F.col("_shift")).alias("_index"), "_total")
