"""Rows and values as JSON text, and JSON text as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import instants

_OPTIONS = {"ignoreNullFields": "false"}


def _instant_text(c: Column) -> Column:
    """UTC ISO text with 0, 3 or 6 fractional digits, as few as the value needs."""
    micros = F.pmod(F.unix_micros(c), F.lit(1_000_000))
    return (
        F.when(micros == 0, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(micros % 1000 == 0, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )


def _needs_work(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _needs_work(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _needs_work(dtype.valueType) or not isinstance(dtype.keyType, T.StringType)
    if isinstance(dtype, T.StructType):
        return any(_needs_work(f.dataType) for f in dtype)
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.TimestampType, T.TimestampNTZType))


def jsonable(c: Column, dtype: T.DataType, zone: str = "UTC") -> Column:
    """The value in a form ``to_json`` renders right: no NaN, exact instants, text map keys."""
    if not _needs_work(dtype):
        return c
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        infinite = c.isin(float("inf"), float("-inf"))
        return F.when(~F.isnan(c) & ~infinite, c)
    if isinstance(dtype, T.TimestampType):
        return _instant_text(c)
    if isinstance(dtype, T.TimestampNTZType):
        return _instant_text(instants.from_local(c, zone))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: jsonable(x, dtype.elementType, zone))
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(c),
            lambda e: F.struct(
                e.getField("key").cast("string").alias("key"),
                jsonable(e.getField("value"), dtype.valueType, zone).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    fields = [jsonable(c.getField(f.name), f.dataType, zone).alias(f.name) for f in dtype]
    return F.when(c.isNotNull(), F.struct(*fields))


def to_json_value(c: Column, dtype: T.DataType, zone: str = "UTC") -> Column:
    """One value as JSON text; a null gives ``null``."""
    # to_json takes no bare scalars: render {"v":...} and cut the wrapping off
    wrapped = F.to_json(F.struct(jsonable(c, dtype, zone).alias("v")), _OPTIONS)
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def json_object(df: DataFrame, fields: list[str], local_zone: str = "UTC") -> Column:
    """The named fields of a row as one JSON object, nulls kept."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.to_json(F.struct(*[jsonable(F.col(f"`{n}`"), types[n], local_zone).alias(n) for n in fields]), _OPTIONS)


def json_rows(df: DataFrame, local_zone: str = "UTC") -> DataFrame:
    """Each row as one JSON object, fields in column order."""
    return df.select(json_object(df, df.columns, local_zone).alias("json"))


_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
# A string without quotes inside, or a number, as JSON spells them.
_SCALAR = r'"([^"]*+)"|(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+\-]?[0-9]++)?+)'
_MARK = "\x01"


def json_flatten(df: DataFrame, column: str) -> DataFrame:
    """Key and value of every flat member of a JSON object; nested members and broken text give no rows.

    Values come out as the text has them (``1e3``, ``1.0``), strings without their quotes (``null`` for a JSON
    null). An object that repeats a key counts as broken.
    """
    # With escaped quotes and backslashes spelled by number no string has a quote inside, and one pattern finds strings and
    # numbers. Numbers become strings, so the parser keeps their spelling; a mark behind a string and before a number
    # tells them from each other and from true, false and nested text.
    text = F.replace(F.replace(F.col(f"`{column}`"), F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    marked = F.regexp_replace(text, _SCALAR, '"$1\\\\u0001$2"')
    members = df.withColumn("_members", F.from_json(marked, "map<string,string>", _STRICT))
    once = F.size(F.array_distinct(F.map_keys("_members"))) == F.size("_members")
    # the outer form, as the plain one comes with a filter that would parse the text a second time
    spread = members.select(*[F.col(f"`{c}`") for c in df.columns], F.explode_outer(F.when(once, F.col("_members"))).alias("_key", "_value"))
    value = F.col("_value")
    plain = (
        F.when(value.isNull(), F.lit("null")).when(value.endswith(_MARK), F.expr("left(_value, length(_value) - 1)"))
        .when(value.startswith(_MARK), F.substr(value, F.lit(2))).otherwise(value)
    )
    flat = value.isNull() | value.endswith(_MARK) | ~(value.startswith("{") | value.startswith("["))
    kept = spread.where(F.col("_key").isNotNull() & flat)
    return kept.select(*[F.col(f"`{c}`") for c in df.columns], F.expr("left(_key, length(_key) - 1)").alias("key"), plain.alias("value"))


def unknown_fields(text: Column, known: list[str]) -> Column:
    """Names of the JSON object's fields that are not in ``known``; null when the text is no object."""
    return F.array_except(F.json_object_keys(text), F.array(*[F.lit(k) for k in known]).cast("array<string>"))


def _has_tuple(t: ColumnType) -> bool:
    return t.kind == "Tuple" or any(_has_tuple(c) for c in t.children)


def unknown_in(text: Column, t: ColumnType, path: str) -> Column:
    """Paths of all fields, at any depth of a JSON text, that the tuples of type ``t`` do not have; empty for other text."""
    none = F.array().cast("array<string>")
    if not _has_tuple(t):
        return none
    if t.kind == "Tuple":
        known = F.array(*[F.lit(n) for n in t.child_names])
        lead = f"{path}." if path else ""
        own = F.transform(F.coalesce(F.array_except(F.json_object_keys(text), known), none), lambda k: F.concat(F.lit(lead), k))
        below = [unknown_in(F.get_json_object(text, f"$['{n}']"), c, f"{lead}{n}") for n, c in zip(t.child_names, t.children, strict=True) if _has_tuple(c)]
        return F.concat(own, *below) if below else own
    if t.kind == "Map":
        names = F.json_object_keys(text)
        once = F.size(F.array_distinct(names)) == F.size(names)
        parts, inner = F.map_values(F.when(once, F.from_json(text, "map<string,string>"))), t.children[1]
    else:
        parts, inner = F.from_json(text, "array<string>"), t.element
    found = F.flatten(F.transform(parts, lambda x: F.coalesce(unknown_in(x, inner, f"{path}[]"), none)))
    return F.array_distinct(F.coalesce(found, none))
