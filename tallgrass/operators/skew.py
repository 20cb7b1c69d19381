"""A lookup join that stays even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_KEYS = 4096
SPREAD = 65_536


def hottest(table: DataFrame, key: str, weight: str, limit: int = HOT_KEYS) -> DataFrame:
    """The ``limit`` heaviest keys.

    ``limit`` bounds the size whatever the data. A key outside the result has
    at least ``limit`` keys as heavy as itself, so it holds at most
    ``1/limit`` of all the weight.
    """
    return table.orderBy(F.desc(weight), key).limit(limit)


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    weight: str,
    spread_by: list[str],
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has one record per ``key``.

    ``weight`` is a non-null integer column of ``table`` that says how many
    rows a key has. The heaviest keys are answered from a broadcast of at most
    ``hot_keys`` records. Their rows then go to partitions chosen by
    ``spread_by`` instead of by the key, where they meet no record, so no task
    receives a hot key as a whole. All other keys join by key, as a shuffle or
    as a broadcast, whichever the size of ``table`` allows.
    """
    values = [c for c in table.columns if c != key]
    # Both uses of the table keep the same rows and columns, the weight last, so
    # Spark computes it once and reuses the shuffle.
    table = table.select(key, *[v for v in values if v != weight], weight).filter(F.col(key).isNotNull())
    hot = hottest(table, key, weight, hot_keys).select(
        key, *[F.col(v).alias(f"_hot_{v}") for v in table.columns[1:]]
    )
    # Slot 0 is computed: the optimizer would move a literal out of the join
    # keys, and rows would be shuffled by the key alone.
    always_zero = F.pmod(F.col(weight), F.lit(1))
    cold = table.select(
        key, *[F.col(v).alias(f"_cold_{v}") for v in table.columns[1:]], always_zero.alias("_slot")
    )
    slot = F.when(F.col(f"_hot_{weight}").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)) + 1
    )
    joined = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_slot", slot)
        .join(cold, [key, "_slot"], "left")
    )
    return joined.select(
        *rows.columns, *[F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values]
    )


def lookup_used(rows: DataFrame, table: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one record per ``key``.

    Counts first how often each key is used, which tells the hot keys and
    leaves only records that are needed.
    """
    uses = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_uses"))
    found = lookup_join(rows, table.join(uses, key), key, "_uses", spread_by)
    return found.filter(F.col("_uses").isNotNull()).drop("_uses")
