import pytest

from tallgrass.operators.numbering import numbered


def test_equal_rows_are_numbered_over_several_ranges(spark):
    rows = spark.range(0, 4000, 1, 4).selectExpr("if(id % 3 = 0, 7, id) as key", "'g' as g")
    found = sorted(numbered(rows, ["key"], ["g"]).collect(), key=lambda r: r._index)
    assert [r._index for r in found] == list(range(4000)) and {r._total for r in found} == {4000}
    assert [r.key for r in found] == sorted(r.key for r in found)


@pytest.mark.parametrize("within", [[], ["g"]])
def test_numbers_in_groups_with_null_keys(spark, within):
    rows = [(f"g{i % 3 if i % 5 else 0}", None if i % 50 == 0 else i * 37 % 101) for i in range(600)]
    found = numbered(spark.createDataFrame(rows, "g string, key int"), ["key"], within).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.g if within else None, []).append(r)
    for group in groups.values():
        group.sort(key=lambda r: r._index)
        keys = [(r.key is not None, r.key or 0) for r in group]
        assert [r._index for r in group] == list(range(len(group))) and {r._total for r in group} == {len(group)}
        assert keys == sorted(keys)


def test_no_rows(spark):
    assert numbered(spark.createDataFrame([], "key int"), ["key"]).count() == 0
