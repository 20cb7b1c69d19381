"""Six reports over the order tables. Each takes DataFrames and returns one.

Size-dependent joins are left to the optimizer: a side is broadcast only when
its measured size is below ``spark.sql.autoBroadcastJoinThreshold``. Fact rows
are aggregated before they are joined wherever the result allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.operators.bloom import bloom_filter, maybe_in
from tallgrass.operators.skew import lookup_used

TOP_ROWS = 20  # fixed value: rows of the two top-k reports
DEFAULT_NATIONS = ("CANADA", "UNITED STATES")  # fixed value


def shipped_on(lineitem: DataFrame, date: str) -> Column:
    """Equality with a literal of the column's own type, so that it is pushed down."""
    return F.col("l_shipdate") == F.lit(date).cast(lineitem.schema["l_shipdate"].dataType)


def q1(lineitem: DataFrame, date: str) -> DataFrame:
    """How many lines shipped on a date."""
    return lineitem.filter(shipped_on(lineitem, date)).agg(F.count(F.lit(1)).alias("n_lines"))


def q2(lineitem: DataFrame, orders: DataFrame, date: str, detail: str = "o_clerk", top: int = TOP_ROWS) -> DataFrame:
    """First orders with a line shipped on a date: one row per order."""
    shipped = lineitem.filter(shipped_on(lineitem, date)).select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    found = orders.select("o_orderkey", detail).join(shipped, "o_orderkey", "left_semi")
    return found.orderBy("o_orderkey", detail).limit(top)


def q3(lineitem: DataFrame, part: DataFrame, supplier: DataFrame, date: str, top: int = TOP_ROWS) -> DataFrame:
    """First lines shipped on a date with part and supplier names.

    Ties of the order key are sorted by the names.
    """
    lines = lineitem.filter(shipped_on(lineitem, date)).select("l_orderkey", "l_partkey", "l_suppkey")
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    s = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    with_part = lookup_used(lines, p, "l_partkey", spread_by=["l_orderkey", "l_suppkey"])
    named = lookup_used(with_part, s, "l_suppkey", spread_by=["l_orderkey", "l_partkey"])
    order = ("l_orderkey", "p_name", "s_name")
    return named.select(*order).orderBy(*order).limit(top)


def q4(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, date: str
) -> DataFrame:
    """Lines shipped on a date, by nation of the customer.

    Counts move to the next key before every join, so each join has one row per
    key on both sides and a popular order, customer or nation weighs no more
    than any other.
    """
    per_order = (
        lineitem.filter(shipped_on(lineitem, date))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_customer = (
        per_order.join(orders.select("o_orderkey", "o_custkey"), "o_orderkey")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum("n").alias("n"))
    )
    per_nation = (
        per_customer.join(customer.select("c_custkey", "c_nationkey"), "c_custkey")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.sum("n").alias("n_lines"))
    )
    return (
        per_nation.join(nation.select("n_nationkey", "n_name"), "n_nationkey")
        .select("n_nationkey", "n_name", "n_lines")
        .orderBy("n_nationkey")
    )


def q5(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    nations: Sequence[str] = DEFAULT_NATIONS,
) -> DataFrame:
    """All lines by month, for customers of some nations.

    The nations come first. The keys of wanted customers go, as a Bloom filter, to the
    scan of the orders, and the keys of those orders to the scan of the lines, so that
    few others are shuffled. The joins then are exact. Lines are counted per order and month before, so an order of any size is one row per
    task. A customer with many orders goes through :func:`lookup_used`.
    """
    wanted = customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey")).join(
        nation.filter(F.col("n_name").isin(list(nations))).select("n_nationkey", "n_name"), "n_nationkey"
    )
    placed = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    likely = maybe_in(placed, "c_custkey", bloom_filter(wanted, "c_custkey"))
    placed = lookup_used(likely, wanted, "c_custkey", spread_by=["l_orderkey"])
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    lines = maybe_in(lineitem.select("l_orderkey", "l_shipdate"), "l_orderkey", bloom_filter(likely, "l_orderkey"))
    per_order = lines.groupBy("l_orderkey", month.alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_order.join(placed.select("l_orderkey", "n_nationkey", "n_name"), "l_orderkey")
        .groupBy("n_nationkey", "n_name", F.substring(F.col("month").cast("string"), 1, 7).alias("month"))
        .agg(F.sum("n").alias("n_lines"))
        .orderBy("n_nationkey", "month")
    )


def q6(lineitem: DataFrame, date: str) -> DataFrame:
    """Pricing summary of the lines shipped on a date, by flag and status."""
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        lineitem.filter(shipped_on(lineitem, date))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_extendedprice").alias("sum_base_price"),
            F.sum(price).alias("sum_disc_price"),
            F.sum(price * (1 + F.col("l_tax"))).alias("sum_charge"),
            F.avg("l_quantity").alias("avg_qty"),
            F.avg("l_extendedprice").alias("avg_price"),
            F.avg("l_discount").alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )
