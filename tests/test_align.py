import pytest

from quayside.operators.align import AlignmentError, align
from quayside.types import ColumnSpec, spec

TABLE = spec(("id", "UInt32"), ("name", "String"), ("flag", "Nullable(Bool)"))


def test_table_order_and_subset(spark):
    assert align(spark.createDataFrame([("ab", 7)], "name string, id int"), TABLE).columns == ["id", "name"]


def test_refusals_name_the_field(spark):
    table = [ColumnSpec("id", "UInt32"), ColumnSpec("doubled", "UInt64", computed=True), ColumnSpec("tags", "Map(String, String)"), ColumnSpec("many", "Array(Tuple(Int8))")]
    cases = [("id int, doubled bigint", "computed"), ("id int, nope string", "nope"), ("id int, tags map<string,string>", "JSON path"),
             ("many array<struct<a:int>>", "JSON path"), ("ID int", "ID")]
    for schema, why in cases:
        with pytest.raises(AlignmentError, match=why):
            align(spark.createDataFrame([], schema), table)
    with pytest.raises(AlignmentError, match="no record field"):
        align(spark.range(1).select(), table)
    assert align(spark.createDataFrame([], "tags map<string,string>"), table, typed=False).columns == ["tags"]


def test_defaults_fill_absent_columns(spark):
    table = [ColumnSpec("id", "UInt32"), ColumnSpec("name", "String", default="'none'"), ColumnSpec("score", "Nullable(Float64)"), ColumnSpec("n", "Int8"), ColumnSpec("c", "Int8", computed=True)]
    row = align(spark.createDataFrame([(1,)], "id int"), table, fill_defaults=True).first()
    assert row.asDict() == {"id": 1, "name": "none", "score": None, "n": 0}
