"""Scalar statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_STEP = 256  # logarithms of one step apart are summed as they are: e^256 is far inside a double


def pmi(n_xy: Column, n_x: Column, n_y: Column, n_lines: Column) -> Column:
    """Pointwise mutual information, base 10, in doubles."""
    return F.log10(n_xy.cast("double") * n_lines / (n_x.cast("double") * n_y))


def logistic(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def label_to_target(label: Column) -> Column:
    """1 for ``spam``, 0 for any other label."""
    return (label == "spam").cast("int")


def predicted_label(score: Column) -> Column:
    """``spam`` above zero; a score of exactly zero is ``ham``."""
    return F.when(score > 0, F.lit("spam")).otherwise(F.lit("ham"))


def log_sums(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(*keys, value)``: per key, the logarithm of the sum of what the logarithms in ``value`` stand for.

    Two phases: values are summed, as multiples of ``e^256``, with those of their own
    size, inside the tasks first; then the few sums of a key are added relative to its
    largest. So no value underflows beside others of its size, and none overflows. Null
    stands for zero; a key with nothing else has no row.
    """
    size = F.floor(F.col(value) / _STEP)
    scaled = rows.filter(F.col(value).isNotNull()).select(*keys, size.alias("_size"), F.exp(F.col(value) - size * _STEP).alias("_part"))
    sums = scaled.groupBy(*keys, "_size").agg(F.sum("_part").alias("_part"))
    found = sums.groupBy(*keys).agg(F.max("_size").alias("_top"), F.collect_list(F.struct("_size", "_part")).alias("_parts"))
    total = F.aggregate("_parts", F.lit(0.0), lambda acc, p: acc + p["_part"] * F.exp((p["_size"] - F.col("_top")) * float(_STEP)))
    return found.select(*keys, (F.col("_top") * _STEP + F.ln(total)).alias(value))
