import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from tallgrass.plans import relational
from tallgrass.plans.queries import NATIONS, SHIP_DATE
from tallgrass.sources import tables

DATE = "1998-08-23"
LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate date"


def day(spark, rows):
    return spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, d string").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("d").cast("date").alias("l_shipdate")
    )


def test_filter_reaches_the_scan(spark):
    lineitem = tables.load_table(spark, SMALL, "lineitem")
    plan = plan_of(relational.q1(lineitem, DATE))
    assert "EqualTo(l_shipdate,1998-08-23T00:00)" in plan
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan


def test_no_row_on_the_date_counts_zero(spark):
    assert relational.q1(day(spark, [(1, 1, 1, "1999-01-01")]), DATE).first().n_lines == 0


def test_string_dates(spark):
    lines = spark.createDataFrame([(1, DATE), (1, "1998-07-01")], "l_orderkey long, l_shipdate string")
    assert relational.q1(lines, DATE).first().n_lines == 1
    orders = spark.createDataFrame([(1, 5)], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame([(5, 2)], "c_custkey long, c_nationkey int")
    nation = spark.createDataFrame([(2, "CANADA")], "n_nationkey int, n_name string")
    got = relational.q5(lines, orders, customer, nation).collect()
    assert [tuple(r) for r in got] == [(2, "CANADA", "1998-07", 1), (2, "CANADA", "1998-08", 1)]


def test_an_order_with_two_lines_on_the_date_is_listed_once(spark):
    lines = day(spark, [(1, 1, 1, DATE), (1, 2, 1, DATE), (2, 1, 1, "1998-08-24"), (9, 1, 1, DATE)])
    orders = spark.createDataFrame([(1, "x"), (2, "y")], "o_orderkey long, o_clerk string")
    assert [tuple(r) for r in relational.q2(lines, orders, DATE).collect()] == [(1, "x")]


def test_first_twenty_with_ties(spark):
    lines = day(spark, [(k // 3, k % 5, k % 2, DATE) for k in range(90)])
    part = spark.createDataFrame([(k, f"p{9 - k}") for k in range(5)], "p_partkey long, p_name string")
    supplier = spark.createDataFrame([(0, "a"), (1, "b")], "s_suppkey long, s_name string")
    got = [tuple(r) for r in relational.q3(lines, part, supplier, DATE).collect()]
    wanted = sorted((k // 3, f"p{9 - k % 5}", "ab"[k % 2]) for k in range(90))[:20]
    assert got == wanted


def test_lines_and_orders_without_partner_do_not_use_up_the_first_twenty(spark):
    lines = day(spark, [(k, k % 7, k % 3, DATE) for k in range(100)])
    part = spark.createDataFrame([(k, f"p{k}") for k in (1, 3, 6)], "p_partkey long, p_name string")
    supplier = spark.createDataFrame([(0, "a"), (1, "b")], "s_suppkey long, s_name string")
    got = [tuple(r) for r in relational.q3(lines, part, supplier, DATE).collect()]
    wanted = [(k, f"p{k % 7}", "ab"[k % 3]) for k in range(100) if k % 7 in (1, 3, 6) and k % 3 < 2][:20]
    assert got == wanted and len(got) == 20
    orders = spark.createDataFrame([(k, f"c{k}") for k in range(30, 90)], "o_orderkey long, o_clerk string")
    assert [tuple(r) for r in relational.q2(lines, orders, DATE).collect()] == [(k, f"c{k}") for k in range(30, 50)]


def test_first_twenty_of_nothing(spark):
    lines = day(spark, [(1, 1, 1, "1999-01-01")])
    part = spark.createDataFrame([(1, "p")], "p_partkey long, p_name string")
    supplier = spark.createDataFrame([(1, "s")], "s_suppkey long, s_name string")
    assert relational.q3(lines, part, supplier, DATE).collect() == []


def test_counts_by_nation_with_a_hot_customer(spark, no_broadcast):
    lines = day(spark, [(k, 1, 1, DATE) for k in range(60)] * 2)
    orders = spark.createDataFrame([(k, 0 if k % 3 else k) for k in range(60)], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame([(k, k % 2) for k in range(60)], "c_custkey long, c_nationkey int")
    nation = spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey int, n_name string")
    custkeys = [0 if k % 3 else k for k in range(60)] * 2
    wanted = [(n, "AB"[n], sum(c % 2 == n for c in custkeys)) for n in (0, 1)]
    got = relational.q4(lines, orders, customer, nation, DATE)
    assert [tuple(r) for r in got.collect()] == wanted


@pytest.fixture(scope="module")
def text_dir(spark, tmp_path_factory):
    """The Parquet tables as ``.tbl`` text; columns we lack are left empty."""
    root = tmp_path_factory.mktemp("text")
    for name, ddl in tables.TEXT_SCHEMAS.items():
        have = tables.load_table(spark, SMALL, name)
        names = [c.split()[0] for c in ddl.split(", ")]
        kinds = dict(c.split() for c in ddl.split(", "))
        columns = [
            (F.col(c).cast("date") if kinds[c] == "date" else F.col(c)) if c in have.columns else F.lit("").alias(c)
            for c in names
        ]
        tables.format_delimited(have.select([c.alias(n) for c, n in zip(columns, names)])).write.text(
            str(root / f"{name}.tbl")
        )
    return str(root)


def reports(spark, root, fmt):
    def get(name):
        return tables.load_table(spark, root, name, fmt)

    lineitem, orders, customer, nation = map(get, ("lineitem", "orders", "customer", "nation"))
    return [
        relational.q1(lineitem, SHIP_DATE),
        relational.q2(lineitem, orders, SHIP_DATE, "o_orderpriority"),
        relational.q3(lineitem, get("part"), get("supplier"), SHIP_DATE),
        relational.q4(lineitem, orders, customer, nation, SHIP_DATE),
        relational.q5(lineitem, orders, customer, nation, NATIONS),
        relational.q6(lineitem, SHIP_DATE),
    ]


def test_text_and_parquet_tables_give_the_same_reports(spark, text_dir):
    for text, parquet in zip(reports(spark, text_dir, "text"), reports(spark, SMALL, "parquet")):
        assert text.columns == parquet.columns
        assert [str(tuple(r)) for r in text.collect()] == [str(tuple(r)) for r in parquet.collect()]


def test_unknown_format_raises(spark):
    with pytest.raises(ValueError):
        tables.load_table(spark, SMALL, "nation", "orc")


def test_plain_folder_layout(spark, tmp_path):
    tables.load_table(spark, SMALL, "nation").write.parquet(str(tmp_path / "nation"))
    assert tables.load_table(spark, str(tmp_path), "nation", suffix="").count() == 25
