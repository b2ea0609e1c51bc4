"""Query results in the types and forms record writers take.

``normalize`` is one ``select``: it casts every column to its output type and
rewrites the values that need it (fixed strings, enums, nested values, addresses).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.convert import enum_names
from quayside.functions.jsontext import to_json_value
from quayside.types import INT_BOUNDS, WIDE_INTS, ColumnSpec, ColumnType


class ResultError(ValueError):
    """A result cannot be written as records."""


def output_type(t: ColumnType) -> T.DataType:
    """The record type of a result column.

    64-bit unsigned and wider integers are "bigint" records; Spark keeps UInt64 as
    decimal(20,0) and the wider ones as digits.
    """
    if t.kind in ("Int8", "Int16", "Int32", "UInt8", "UInt16"):
        return T.IntegerType()
    if t.kind in ("Int64", "UInt32"):
        return T.LongType()
    if t.kind == "UInt64":
        return T.DecimalType(20, 0)
    if t.kind == "Decimal":
        return T.DecimalType(t.precision, t.scale) if t.precision <= 38 else T.StringType()
    if t.kind in ("Array", "Nested"):
        return T.ArrayType(output_type(t.element)) if t.kind == "Array" else T.StringType()
    if t.kind == "Map":
        return T.MapType(T.StringType(), output_type(t.children[1]))
    if t.kind == "Tuple":
        pairs = zip(t.child_names, t.children, strict=True)
        return T.StructType([T.StructField(n, output_type(child)) for n, child in pairs])
    return {
        "Float32": T.FloatType(), "Float64": T.DoubleType(), "Bool": T.BooleanType(),
        "Date": T.DateType(), "Date32": T.DateType(),
        "DateTime": T.TimestampType(), "DateTime64": T.TimestampType(),
    }.get(t.kind, T.StringType())


def output_schema(columns: list[ColumnSpec]) -> T.StructType:
    """Record schema of a result: column order kept, every field nullable."""
    return T.StructType([T.StructField(s.name, output_type(s.type), True) for s in columns])


def ip_text(c: Column, dtype: T.DataType) -> Column:
    """An address as text; packed 32-bit numbers become dotted quads, 16 bytes become eight groups."""
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        octets = [F.shiftright(c.cast("bigint"), s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
        return F.concat_ws(".", *octets)
    if isinstance(dtype, T.BinaryType):
        digits = F.lower(F.hex(c))
        groups = [F.regexp_replace(F.substring(digits, 4 * i + 1, 4), "^0{1,3}", "") for i in range(8)]
        return F.when(F.octet_length(c) == 16, F.concat_ws(":", *groups))
    return c.cast("string")


def _map(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    if not isinstance(dtype, T.MapType):
        # a value that is no map gives an empty one
        return F.when(c.isNotNull(), F.create_map().cast(output_type(t)))
    value = t.children[1]
    return F.map_from_entries(
        F.transform(
            F.map_entries(c),
            lambda e: F.struct(
                e.getField("key").cast("string").alias("key"),
                record_value(e.getField("value"), dtype.valueType, value).alias("value"),
            ),
        )
    )


def _tuple(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    if isinstance(dtype, T.StructType):
        items = [(c.getField(f.name), f.dataType) for f in dtype]
    else:
        items = [(c, dtype)]
    fields = []
    for i, (name, child) in enumerate(zip(t.child_names, t.children, strict=True)):
        value = record_value(*items[i], child) if i < len(items) else F.lit(None).cast(output_type(child))
        fields.append(value.alias(name))
    return F.when(c.isNotNull(), F.struct(*fields))


def record_value(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    """One result value in its record form; null stays null."""
    kind = t.kind
    if kind == "FixedString":
        return F.rtrim(c.cast("string"), F.lit("\0"))
    if kind in ("Enum8", "Enum16") and isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(F.try_element_at(enum_names(t), c.cast("int")), c.cast("string"))
    if kind in ("IPv4", "IPv6"):
        return ip_text(c, dtype)
    if kind == "Array":
        if isinstance(dtype, T.ArrayType):
            return F.transform(c, lambda x: record_value(x, dtype.elementType, t.element))
        return F.when(c.isNotNull(), F.array(record_value(c, dtype, t.element)))
    if kind == "Map":
        return _map(c, dtype, t)
    if kind == "Tuple":
        return _tuple(c, dtype, t)
    if kind in ("JSON", "Object", "Dynamic", "Variant", "Nested"):
        if isinstance(dtype, T.StringType):
            return c
        return F.when(c.isNotNull(), F.to_json(c) if isinstance(dtype, T.VariantType) else to_json_value(c, dtype))
    if kind in INT_BOUNDS and kind not in WIDE_INTS and isinstance(dtype, T.StringType):
        return c.try_cast(output_type(t))
    return c.cast(output_type(t))


def refuse_duplicates(df: DataFrame) -> None:
    """Records are read by field name, so a result may not use a name twice."""
    doubled = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if doubled:
        raise ResultError(f"the result has several columns named {doubled}; give each an alias")


def default_spec(df: DataFrame) -> list[ColumnSpec]:
    """Column types of a result as Spark reports them, for results without a spec of their own."""
    return [ColumnSpec(f.name, type_text(f.dataType)) for f in df.schema.fields]


def type_text(dtype: T.DataType) -> str:
    """The target type text that corresponds to a Spark type."""
    if isinstance(dtype, T.DecimalType):
        return f"Decimal({dtype.precision}, {dtype.scale})"
    if isinstance(dtype, T.ArrayType):
        return f"Array({type_text(dtype.elementType)})"
    if isinstance(dtype, T.MapType):
        return f"Map(String, {type_text(dtype.valueType)})"
    if isinstance(dtype, T.StructType):
        return "Tuple(" + ", ".join(f"`{f.name}` {type_text(f.dataType)}" for f in dtype) + ")"
    return {
        "tinyint": "Int8", "smallint": "Int16", "int": "Int32", "bigint": "Int64", "float": "Float32", "double": "Float64",
        "boolean": "Bool", "date": "Date32", "timestamp": "DateTime64(6)", "timestamp_ntz": "DateTime64(6)", "variant": "JSON",
    }.get(dtype.simpleString(), "String")


def normalize(df: DataFrame, columns: list[ColumnSpec] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The result in record form.

    ``columns`` gives the source type of each column (by name; Spark's own types
    otherwise). ``schema`` projects the records onto a writer's schema: its fields, in
    its order, a missing field as null. Every field may be null, also one the query says never is.
    """
    refuse_duplicates(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    chosen = columns if columns is not None else default_spec(df)
    records = df.select(*[record_value(F.col(f"`{s.name}`"), types[s.name], s.type).alias(s.name) for s in chosen])
    if schema is not None:
        have = set(records.columns)
        records = records.select(
            *[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        )
    # a condition that is always true: the plan drops it, the schema keeps what it allows
    return records.select(*[F.col(f"`{f.name}`") if f.nullable else F.when(F.col(f"`{f.name}`").isNotNull(), F.col(f"`{f.name}`")).alias(f.name) for f in records.schema])
