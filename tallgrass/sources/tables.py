"""Relational tables from Parquet or from ``|``-delimited text, one schema for both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# Column order of the ``.tbl`` layout (fixed by the public TPC-H specification).
TEXT_SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate date, l_commitdate date, "
    "l_receiptdate date, l_shipinstruct string, l_shipmode string, l_comment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate date, o_orderpriority string, o_clerk string, o_shippriority int, o_comment string",
    "customer": "c_custkey long, c_name string, c_address string, c_nationkey int, c_phone string, "
    "c_acctbal double, c_mktsegment string, c_comment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int, n_comment string",
    "part": "p_partkey long, p_name string, p_mfgr string, p_brand string, p_type string, p_size int, "
    "p_container string, p_retailprice double, p_comment string",
    "supplier": "s_suppkey long, s_name string, s_address string, s_nationkey int, s_phone string, "
    "s_acctbal double, s_comment string",
}

_SUFFIX = {"parquet": ".parquet", "text": ".tbl"}


def load_table(
    spark: SparkSession, root: str, name: str, fmt: str = "parquet", suffix: str | None = None
) -> DataFrame:
    """Load ``root/name`` as Parquet or delimited text.

    ``suffix=""`` reads a table stored in a plain ``root/name`` folder.
    """
    if fmt not in _SUFFIX:
        raise ValueError(f"unknown format {fmt!r}: expected one of {sorted(_SUFFIX)}")
    path = f"{root}/{name}{_SUFFIX[fmt] if suffix is None else suffix}"
    if fmt == "parquet":
        return spark.read.parquet(path)
    # The layout ends every line with the separator: one empty column more.
    schema = T.StructType.fromDDL(TEXT_SCHEMAS[name]).add("_line_end", T.StringType())
    return (
        spark.read.schema(schema).option("sep", "|").option("quote", "").csv(path).drop("_line_end")
    )


def parse_delimited(lines: DataFrame, schema: str, sep: str = "|") -> DataFrame:
    """Parse a ``value`` column of delimited lines that are already in a DataFrame."""
    ddl = T.StructType.fromDDL(schema).add("_line_end", T.StringType()).simpleString()
    inner = ddl[len("struct<") : -1].replace(":", " ")
    row = F.from_csv("value", inner, {"sep": sep, "quote": ""})
    return lines.select(row.alias("r")).select("r.*").drop("_line_end")


def format_delimited(table: DataFrame, sep: str = "|") -> DataFrame:
    """The inverse of :func:`parse_delimited`: one ``value`` line per row."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in table.columns]
    return table.select(F.concat(F.concat_ws(sep, *fields), F.lit(sep)).alias("value"))


def widen(table: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan over all task slots if the files give fewer splits than slots.

    Large inputs have more splits than slots and pass through without a shuffle.
    ``keys`` should be close to unique, so that the hash partitions are even.
    """
    slots = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= slots:
        return table
    return table.repartition(slots, *keys)
