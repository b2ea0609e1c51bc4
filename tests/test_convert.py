"""Conversion rules: accepted spellings, defaults, refusals, messages, rounding, time zones."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from quayside.functions.convert import ERRORS, conform
from quayside.types import TypeTextError, read_type, spec, storage_type

UTC = dt.timezone.utc
TS = dt.datetime(2024, 3, 15, 11, 45, 10)


def convert(spark, type_text, value, sql_type="string", zone="Europe/Bucharest"):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", T._parse_datatype_string(sql_type))]))
    if sql_type == "timestamp":
        df = spark.createDataFrame([(value.replace(tzinfo=UTC) if value else None,)], df.schema)
    row = conform(df, spec(("c", type_text)), zone).first()
    return row["c"], row[ERRORS]


def many(spark, type_text, values, sql_type="string", zone="Europe/Bucharest"):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("c", T._parse_datatype_string(sql_type))])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    rows = conform(df, spec(("c", type_text)), zone, keep=["i"]).orderBy("i").collect()
    return [(r["c"], list(r[ERRORS])) for r in rows]


ACCEPTED = [
    ("Int8", -5, [("string", ["-5", " -5 ", "-5.0", "-5.", "-50e-1", "-0.5E1", "-005"]), ("int", [-5]), ("bigint", [-5]), ("double", [-5.0]), ("decimal(5,2)", [Decimal("-5.00")])]),
    ("Int8", -128, [("int", [-128])]),
    ("UInt8", 255, [("int", [255]), ("string", ["255", "255.000"])]),
    ("UInt8", 1, [("boolean", [True])]),
    ("Int16", -300, [("smallint", [-300]), ("string", ["-3e2"])]),
    ("UInt16", 65535, [("int", [65535])]),
    ("Int32", -123456789, [("string", ["-123456789"])]),
    ("UInt32", 4294967295, [("bigint", [4294967295]), ("string", ["4294967295"])]),
    ("Int64", -9000000000, [("bigint", [-9000000000]), ("string", ["-9000000000", "-9e9"])]),
    ("Int64", 9223372036854775807, [("string", ["9223372036854775807", "9223372036854775807.0"])]),
    ("UInt64", Decimal("18446744073709551615"), [("string", ["18446744073709551615", "18446744073709551615.00"]), ("decimal(20,0)", [Decimal("18446744073709551615")])]),
    ("Int128", "-170141183460469231731687303715884105728", [("string", ["-170141183460469231731687303715884105728", "-170141183460469231731687303715884105728.0"])]),
    ("UInt128", "340282366920938463463374607431768211455", [("string", ["340282366920938463463374607431768211455"])]),
    ("Int256", str(-(2**255)), [("string", [str(-(2**255))])]),
    ("UInt256", str(2**256 - 1), [("string", [str(2**256 - 1)])]),
    ("UInt256", "1" + "0" * 40, [("string", ["1e40"])]),
    ("Int128", "12", [("bigint", [12]), ("double", [12.0]), ("string", ["0012"])]),
    ("Float32", 1.5, [("float", [1.5]), ("double", [1.5]), ("string", ["1.5", " 1.5 "])]),
    ("Float64", -2.25, [("double", [-2.25]), ("string", ["-2.25"]), ("decimal(5,2)", [Decimal("-2.25")])]),
    ("Float64", 1.0, [("boolean", [True])]),
    ("Float64", float("-inf"), [("string", ["-Infinity"])]),
    ("Decimal(9, 2)", Decimal("12345.67"), [("decimal(10,3)", [Decimal("12345.670")]), ("string", ["12345.67", " 12345.67"]), ("double", [12345.67])]),
    ("Decimal(18, 4)", Decimal("-1.2345"), [("string", ["-1.2345"])]),
    ("Decimal(38, 10)", Decimal("123456789012345678.1234567891"), [("string", ["123456789012345678.1234567891"])]),
    ("Decimal(76, 5)", "-" + "9" * 71 + ".99999", [("string", ["-" + "9" * 71 + ".99999"])]),
    ("Decimal32(2)", Decimal("7.00"), [("int", [7])]),
    ("String", "Stăvilar ✓", [("string", ["Stăvilar ✓"])]),
    ("String", "", [("string", [""])]),
    ("String", "x" * 200, [("string", ["x" * 200])]),
    ("String", "7", [("int", [7])]),
    ("FixedString(5)", "ab", [("string", ["ab", "ab\0\0"]), ("binary", [bytearray(b"ab")])]),
    ("FixedString(3)", "abc", [("string", ["abc"])]),
    ("Bool", True, [("boolean", [True]), ("int", [1]), ("string", ["true", "1", "YES", " y ", "T"]), ("double", [0.5])]),
    ("Bool", False, [("boolean", [False]), ("int", [0]), ("string", ["false", "0", "No", "n", "f", "", "  "])]),
    ("UUID", "123e4567-e89b-12d3-a456-426614174000", [("string", ["123e4567-e89b-12d3-a456-426614174000", " 123E4567-E89B-12D3-A456-426614174000\n"])]),
    ("Date", dt.date(2024, 3, 15), [("date", [dt.date(2024, 3, 15)]), ("string", ["2024-03-15", " 2024-03-15 ", "2024-03-15T23:59:59Z"]), ("int", [19797]), ("timestamp", [dt.datetime(2024, 3, 15, 23, 59, 59)])]),
    ("Date", dt.date(1970, 1, 1), [("int", [0])]),
    ("Date", dt.date(2149, 6, 6), [("int", [65535])]),
    ("Date32", dt.date(1950, 1, 2), [("date", [dt.date(1950, 1, 2)]), ("string", ["1950-01-02"])]),
    ("DateTime('UTC')", TS, [
        ("timestamp", [TS]), ("timestamp_ntz", [dt.datetime(2024, 3, 15, 13, 45, 10)]),
        ("string", ["2024-03-15T11:45:10Z", "2024-03-15T14:45:10+03:00", "2024-03-15 13:45:10", "2024-03-15T13:45:10", "2024-03-15T11:45:10.999Z", " 2024-03-15T11:45:10Z ",
                    "2024-03-15T14:45:10+03:00[Europe/Bucharest]", "2024-03-15t11:45:10z"]),
        ("bigint", [1710503110]), ("double", [1710503110.0]),
    ]),
    ("DateTime64(3, 'UTC')", TS.replace(microsecond=123000), [("timestamp", [TS.replace(microsecond=123456)]), ("string", ["2024-03-15T11:45:10.123Z"]), ("decimal(20,9)", [Decimal("1710503110.123")]), ("double", [1710503110.123])]),
    ("DateTime64(9, 'UTC')", TS.replace(microsecond=123456), [("string", ["2024-03-15T11:45:10.123456789Z"])]),
    ("DateTime64(1)", TS.replace(microsecond=900000), [("string", ["2024-03-15T11:45:10.987Z"])]),
    ("DateTime64(3, 'UTC')", dt.datetime(1969, 12, 31, 23, 59, 59, 500000), [("timestamp", [dt.datetime(1969, 12, 31, 23, 59, 59, 500000)]), ("decimal(5,1)", [Decimal("-0.5")])]),
    ("DateTime", dt.datetime(2024, 3, 15), [("date", [dt.date(2024, 3, 15)])]),
    ("Enum8('a' = 1, 'b' = 2)", "b", [("string", ["b", "2"]), ("int", [2])]),
    ("Enum16('x' = -5, 'y' = 300)", "x", [("string", ["x", "-5"]), ("int", [-5])]),
    ("Nullable(Int32)", 42, [("int", [42])]),
    ("LowCardinality(String)", "low", [("string", ["low"])]),
    ("LowCardinality(Nullable(String))", "x", [("string", ["x"])]),
    ("Array(Int32)", [], [("array<int>", [[]])]),
    ("Array(Int32)", [1, -2, 3], [("array<int>", [[1, -2, 3]]), ("array<string>", [["1", "-2", "3"]])]),
    ("Array(Int32)", [1, 0], [("array<int>", [[1, None]])]),
    ("Array(Nullable(Int32))", [1, None, 3], [("array<int>", [[1, None, 3]])]),
    ("Array(Array(String))", [["a", "b"], [], ["c"]], [("array<array<string>>", [[["a", "b"], [], ["c"]]])]),
    ("Array(DateTime('UTC'))", [TS], [("array<string>", [["2024-03-15T11:45:10Z"]])]),
]


@pytest.mark.parametrize("type_text,expected,inputs", ACCEPTED, ids=[f"{i}-{a[0]}" for i, a in enumerate(ACCEPTED)])
def test_accepted_spellings(spark, type_text, expected, inputs):
    for sql_type, values in inputs:
        for value in values:
            got, errors = convert(spark, type_text, value, sql_type)
            assert errors == [], (sql_type, value)
            assert got == expected, (sql_type, value)


def test_not_a_number_is_a_float(spark):
    (value, errors), = many(spark, "Float64", ["NaN"])
    assert value != value and errors == []


@pytest.mark.parametrize("type_text,default", [
    ("Int32", 0), ("String", ""), ("FixedString(3)", ""), ("Bool", False), ("UUID", "00000000-0000-0000-0000-000000000000"),
    ("Date", dt.date(1970, 1, 1)), ("DateTime64(3)", dt.datetime(1970, 1, 1)), ("Enum8('a' = 1, 'b' = 2)", "a"), ("Decimal(9, 2)", Decimal("0.00")),
    ("Int128", "0"), ("Decimal(76, 2)", "0.00"), ("Nullable(Int32)", None), ("LowCardinality(Nullable(String))", None),
])
def test_null_becomes_the_type_default(spark, type_text, default):
    assert convert(spark, type_text, None) == (default, [])


def test_null_array_is_empty(spark):
    assert convert(spark, "Array(Int32)", None, "array<int>") == ([], [])


REFUSED = [
    ("Int8", "int", [128, -129]), ("UInt8", "int", [-1, 256]), ("UInt64", "bigint", [-1]), ("UInt64", "string", ["18446744073709551616", "-1", "1e20"]),
    ("Int32", "double", [1.5, float("nan"), float("inf"), 1e300]), ("Int32", "string", ["abc", "1.5", "", "1e-1", "12 3", "0x1", "2147483648", ".", "1e99999999999"]),
    ("Int64", "string", ["9223372036854775808"]), ("Int64", "double", [1e19]),
    ("Int128", "string", ["-170141183460469231731687303715884105729", "1e40", "x"]), ("UInt256", "string", [str(2**256), "-1"]),
    ("Float64", "string", ["nan", "inf", "-inf", "INFINITY", "1,5", "", "abc"]), ("Float64", "date", [dt.date(2024, 1, 1)]),
    ("Decimal(9, 2)", "decimal(12,2)", [Decimal("12345678.99")]), ("Decimal(9, 2)", "string", ["12345678.99", "abc", "9999999.995"]), ("Decimal(9, 2)", "boolean", [True]),
    ("Decimal(76, 5)", "string", ["9" * 72, "9" * 71 + ".999995", "x"]),
    ("FixedString(3)", "string", ["abcd", "ăă"]), ("Enum8('a' = 1)", "string", ["zzz", "7", "-", " a"]), ("Enum8('a' = 1)", "int", [7]), ("Enum8('a' = 1)", "boolean", [True]),
    ("Date", "date", [dt.date(1960, 1, 1), dt.date(2149, 6, 7)]), ("Date", "string", ["2024-3-5", "2024-02-30", "19797", "2024"]), ("Date", "int", [-1, 65536]), ("Date", "boolean", [True]),
    ("DateTime", "timestamp", [dt.datetime(1960, 1, 1), dt.datetime(2106, 2, 7, 6, 28, 16)]), ("DateTime", "bigint", [-1, 2**32]),
    ("DateTime64(3)", "string", ["2024-03-15", "2024-13-15T11:45:10Z", "2024-03-15T11:45:10.Z", "2024-03-15T11:45:10+0300", "15/03/2024 11:45:10", "1710503110", "2024-02-30T00:00:00Z", "2024-03-15T24:00:00Z"]),
    ("DateTime64(9)", "bigint", [9223372037, -9223372037]),
    ("UUID", "string", ["not-a-uuid", "123e4567e89b12d3a456426614174000"]), ("UUID", "int", [1]), ("Bool", "string", ["maybe", "2"]), ("Bool", "date", [dt.date(2024, 1, 1)]),
    ("Array(Int32)", "string", ["not an array"]), ("Array(Int32)", "array<string>", [["1", "x"]]), ("Array(Nullable(Int32))", "array<string>", [[None, "x"]]),
    ("Array(Array(UInt8))", "array<array<int>>", [[[1], [300]]]),
]


@pytest.mark.parametrize("type_text,sql_type,values", REFUSED, ids=[f"{i}-{a[0]}-{a[1]}" for i, a in enumerate(REFUSED)])
def test_refused_values(spark, type_text, sql_type, values):
    for value in values:
        got, errors = convert(spark, type_text, value, sql_type)
        assert got is None and len(errors) == 1, value


def test_messages_name_column_type_and_value_type(spark):
    df = spark.createDataFrame([("abc", 300)], "amount string, small int")
    row = conform(df, spec(("amount", "Decimal(9, 2)"), ("small", "UInt8"))).first()
    assert row[ERRORS] == [
        "column 'amount' (Decimal(9, 2)): 'abc' is not a number [value of type String]",
        "column 'small' (UInt8): value 300 is outside 0..255 [value of type Integer]",
    ]


def test_decimals_round_half_up(spark):
    got = many(spark, "Decimal(9, 2)", ["12345.675", "-12345.675", "0.005", "-0.004", "1.005"])
    assert [v for v, _ in got] == [Decimal("12345.68"), Decimal("-12345.68"), Decimal("0.01"), Decimal("0.00"), Decimal("1.01")]
    got = many(spark, "Decimal(40, 2)", ["9.995", "-0.004", "199.995", "1e3", "0.005", "7"])
    assert [v for v, _ in got] == ["10.00", "0.00", "200.00", "1000.00", "0.01", "7.00"]
    got = many(spark, "Decimal(60, 8)", ["0.000000005", "1e-8", "99.999999995"])
    assert [v for v, _ in got] == ["0.00000001", "0.00000001", "100.00000000"]


def test_local_times_in_gaps_and_overlaps(spark):
    # Bucharest skips 03:00-04:00 on 31 March 2024 and repeats 03:00-04:00 on 27 October
    got = many(spark, "DateTime", ["2024-03-31 03:30:00", "2024-10-27 03:30:00", "2024-07-01 12:00:00"])
    assert [v for v, _ in got] == [dt.datetime(2024, 3, 31, 1, 30), dt.datetime(2024, 10, 27, 0, 30), dt.datetime(2024, 7, 1, 9, 0)]


def test_nested_targets_from_json_text_and_typed_values(spark):
    df = spark.createDataFrame([('{"a":1,"b":"2"}', '{"id":"7","s":null}', [("x", 1)])], "m string, t string, n array<struct<k:string,v:int>>")
    row = conform(df, spec(("m", "Map(String, Int32)"), ("t", "Tuple(id UInt8, s String)"), ("n", "Nested(k String, v UInt8)"))).first()
    assert row["m"] == {"a": 1, "b": 2} and tuple(row["t"]) == (7, "") and [tuple(x) for x in row["n"]] == [("x", 1)] and row[ERRORS] == []
    bad = spark.createDataFrame([('{"a":"x"}', '{"id":1,"other":2}', "::1", "300.1.1.1", "{")], "m string, t string, six string, four string, j string")
    row = conform(bad, spec(("m", "Map(String, Int32)"), ("t", "Tuple(id UInt8, s String)"), ("six", "IPv6"), ("four", "IPv4"), ("j", "JSON"))).first()
    assert len(row[ERRORS]) == 4 and row["six"] == "::1"


def test_type_texts():
    t = read_type("Array(Nullable(Decimal(9, 2)))")
    assert t.kind == "Array" and t.element.nullable and (t.element.precision, t.element.scale) == (9, 2)
    assert read_type("Enum8('it\\'s' = 1, 'a, b' = -2)").enum == (("it's", 1), ("a, b", -2))
    assert read_type("Tuple(String, id UInt8)").child_names == ("_1", "id")
    assert storage_type(read_type("Map(Int32, Array(UInt64))")).simpleString() == "map<string,array<decimal(20,0)>>"
    for bad in ("Nope", "Decimal(9", "Enum8()", "DateTime64(10)"):
        with pytest.raises(TypeTextError):
            read_type(bad)


def test_conversion_stays_on_the_jvm_and_filters_do_not_repeat_it(spark):
    df = spark.createDataFrame([], "a string, b string")
    plan = conform(df, spec(("a", "Int128"), ("b", "Decimal(76, 5)"))).where(f"size({ERRORS}) = 0")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert all("RLIKE" not in line for line in filters)


def test_other_session_zones_are_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Bucharest")
    try:
        with pytest.raises(ValueError, match="must be UTC"):
            conform(spark.createDataFrame([("1",)], "a string"), spec(("a", "Int8")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
