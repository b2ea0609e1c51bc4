"""Typed conversion of loosely typed columns, one column expression per target type.

``candidate`` turns a non-null input into the stored value, or null when the
input does not fit. ``conform`` applies it to a whole DataFrame, fills the type
defaults and gathers the reasons in ``_errors``. Everything is built-in
expressions: no Python worker, no shuffle.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import instants, jsontext, text
from quayside.types import INT_BOUNDS, WIDE_INTS, ColumnSpec, ColumnType, storage_type

ERRORS = "_errors"
# Where a reader says why it could not parse a record; such a record is a bad row, for this reason alone.
UNREADABLE = "_unreadable"

# Accepted spellings of a boolean.
TRUE_TEXT = ("true", "1", "yes", "y", "t")
FALSE_TEXT = ("false", "0", "no", "n", "f", "")

# The only non-finite spellings of a floating point number.
NON_FINITE = ("NaN", "+NaN", "-NaN", "Infinity", "+Infinity", "-Infinity")

LAST_DATE = dt.date(2149, 6, 6)  # day 65535
LAST_SECOND = 2**32 - 1
ZERO_UUID = "00000000-0000-0000-0000-000000000000"

_UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
_IPV6 = (
    r"^(([0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}$)"
    r"(([0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4})*)?::([0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4})*)?))$"
)

# How a message names the type of a value.
_VALUE_NAMES = {
    "string": "String", "boolean": "Boolean", "tinyint": "Byte", "smallint": "Short", "int": "Integer",
    "bigint": "Long", "float": "Float", "double": "Double", "binary": "byte[]", "date": "LocalDate",
    "timestamp": "Timestamp", "timestamp_ntz": "LocalDateTime",
}

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_NUMERIC = (*_WHOLE, *_FLOATING, T.DecimalType)


def _null(t: ColumnType) -> Column:
    return F.lit(None).cast(storage_type(t))


# up to 18 digits fit 64 bits whatever they are; then maybe a point and zeros
_DIGITS = r"^[+-]?[0-9]{1,18}$"
_DOTTED = r"^[+-]?[0-9]{1,18}\.0*$"


def _may_be_number(c: Column) -> Column:
    """A cheap look at the first character; a cast that fails costs a hundred times more."""
    return (c < ":") & (c != "")


def _whole_text(c: Column, stored: str) -> Column:
    """Text as a whole number.

    Plain digits and ``69.0`` take a pattern and a cast that cannot fail (a failing
    cast costs far more than the pattern); anything else goes by its exact digits.
    """
    plain = F.when(c.rlike(_DIGITS), c.cast("bigint"))
    dotted = F.when(c.rlike(_DOTTED), F.substring_index(c, ".", 1).cast("bigint"))
    exact = text.bind(c, lambda v: text.bind(text.integer_text(v), lambda d: F.when(F.length(d) <= 20, d.try_cast(stored))))
    return F.coalesce(F.coalesce(plain, dotted).cast(stored), exact)


def _whole_number(c: Column, dtype: T.DataType, stored: str = "decimal(20,0)") -> Column | None:
    """The input as a number without fraction, null when it has one."""
    if isinstance(dtype, T.StringType):
        return _whole_text(c, stored)
    if isinstance(dtype, (*_WHOLE, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(dtype, _FLOATING):
        wide = c.cast("double")
        return F.when((wide == F.rint(wide)) & ~F.isnan(wide), wide.try_cast("decimal(38,0)"))
    if isinstance(dtype, T.DecimalType):
        return c if dtype.scale == 0 else F.when(c == F.floor(c), c.cast("decimal(38,0)"))
    return None


def _integer(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    number = _whole_number(c, dtype, "decimal(20,0)" if t.kind == "UInt64" else "bigint")
    return _null(t) if number is None else number


def _literal(n: int) -> Column:
    return F.lit(n) if n < 2**63 else F.lit(Decimal(n))


def _wide_integer(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    low, high = INT_BOUNDS[t.kind]
    exact = lambda d: F.when(text.within_bounds(d, low, high), d)
    if isinstance(dtype, T.StringType):
        # up to 37 digits go through Spark's own decimal and are in range whatever they are
        plain = F.when(c.rlike("^-?[0-9]{1,37}$" if low else "^[0-9]{1,37}$"), c.cast("decimal(38,0)").cast("string"))
        return F.coalesce(plain, text.bind(text.integer_text(c), exact))
    if isinstance(dtype, _FLOATING):
        digits = text.integer_text(c.cast("double").cast("string"))
    else:
        number = _whole_number(c, dtype)
        if number is None:
            return _null(t)
        digits = number.cast("decimal(38,0)").cast("string")
    return text.bind(digits, exact)


def _floating(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    if isinstance(dtype, T.StringType):
        # Spark also takes "inf" and "nan" in any case
        finite = _may_be_number(c) & ~c.contains("n") & ~c.contains("N")
        number = F.when(finite | text.trim(c).isin(*NON_FINITE), c.try_cast("double"))
    elif isinstance(dtype, (*_NUMERIC, T.BooleanType)):
        number = c.cast("double")
    else:
        return _null(t)
    return number.cast("float") if t.kind == "Float32" else number


def _decimal(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    if not isinstance(dtype, (*_NUMERIC, T.StringType)):
        return _null(t)
    if isinstance(dtype, _FLOATING):
        c = c.cast("double")
    if t.precision > 38:
        c = c.cast("string")
        exact = text.decimal_text(c, t.precision, t.scale)
        if t.scale > 6:  # Spark would print small numbers with an exponent
            return exact
        short = rf"^-?[0-9]{{1,{37 - t.scale}}}(\.[0-9]*)?$"
        return F.coalesce(F.when(c.rlike(short), c.cast(f"decimal(38,{t.scale})").cast("string")), exact)
    if isinstance(dtype, T.StringType):
        return F.when(_may_be_number(c), c.try_cast(storage_type(t)))
    return c.try_cast(storage_type(t))


def _fixed_string(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    as_text = c.cast("string")
    size = F.octet_length(c if isinstance(dtype, T.BinaryType) else as_text)
    return F.when(size <= t.precision, F.rtrim(as_text, F.lit("\0")))


def _boolean(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, _NUMERIC):
        return c != 0
    if isinstance(dtype, T.StringType):
        known = lambda w: F.when(w.isin(*TRUE_TEXT), True).when(w.isin(*FALSE_TEXT), False)
        return F.coalesce(known(F.lower(c)), text.bind(F.lower(text.trim(c)), known))
    return _null(t)


def _uuid(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    if not isinstance(dtype, T.StringType):
        return _null(t)
    trimmed = text.bind(F.lower(text.trim(c)), lambda w: F.when(w.rlike(_UUID), w))
    return F.when(F.lower(c).rlike(_UUID), F.lower(c)).otherwise(trimmed)


def _date(c: Column, dtype: T.DataType, t: ColumnType, zone: str) -> Column:
    if isinstance(dtype, T.StringType):
        strict = lambda w: F.when(w.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), w.try_cast("date"))
        trimmed = text.bind(text.trim(c), strict)
        day = F.coalesce(F.when(F.length(c) <= 10, strict(c)), instants.from_text(c, zone).cast("date"), trimmed)
    elif isinstance(dtype, T.DateType):
        day = c
    elif isinstance(dtype, T.TimestampType):
        day = c.cast("date")
    elif isinstance(dtype, T.TimestampNTZType):
        day = instants.from_local(c, zone).cast("date")
    elif isinstance(dtype, _NUMERIC):
        # a day number; fractions are cut
        day = F.date_from_unix_date(c.try_cast("bigint").try_cast("int"))
    else:
        return _null(t)
    return day


def _instant(c: Column, dtype: T.DataType, zone: str) -> Column | None:
    if isinstance(dtype, T.StringType):
        return instants.from_text(c, zone)
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp")
    if isinstance(dtype, T.TimestampNTZType):
        return instants.from_local(c, zone)
    if isinstance(dtype, _NUMERIC):
        return instants.from_seconds(c, fractional=not isinstance(dtype, _WHOLE))
    return None


def _date_time(c: Column, dtype: T.DataType, t: ColumnType, zone: str) -> Column:
    instant = _instant(c, dtype, zone)
    if instant is None:
        return _null(t)
    return instants.floor_to(instant, 0 if t.kind == "DateTime" else t.scale)


def enum_names(t: ColumnType) -> Column:
    """Literal map from declared number to name."""
    return F.create_map(*[F.lit(x) for name, number in t.enum for x in (number, name)])


def _enum(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    by_number = lambda n: F.try_element_at(enum_names(t), n)
    if isinstance(dtype, T.StringType):
        names = [name for name, _ in t.enum]
        return F.when(c.rlike("^[0-9-][0-9]*$"), by_number(c.try_cast("int"))).when(c.isin(*names), c)
    if isinstance(dtype, _NUMERIC):
        return by_number(c.try_cast("int"))
    return _null(t)


def _array(c: Column, dtype: T.DataType, t: ColumnType, zone: str) -> Column:
    if not isinstance(dtype, T.ArrayType):
        return _null(t)
    element, etype = t.element, dtype.elementType
    out = F.transform(c, lambda x: fill(x, candidate(x, etype, element, zone), element))
    if element.nullable:
        # a null that was not there before is an element that did not fit
        lost = F.size(F.filter(out, F.isnull)) != F.size(F.filter(c, F.isnull))
    else:
        lost = F.exists(out, F.isnull)
    return F.when(~lost, out)


def _map(c: Column, dtype: T.DataType, t: ColumnType, zone: str) -> Column:
    if isinstance(dtype, T.StringType):
        raw = T.MapType(T.StringType(), raw_shape(t.children[1]))
        names = F.json_object_keys(c)
        once = F.size(F.array_distinct(names)) == F.size(names)
        return _map(F.when(once & (F.size(jsontext.unknown_in(c, t, "")) == 0), F.from_json(c, raw)), raw, t, zone)
    if isinstance(dtype, T.StructType):
        pairs = [F.struct(F.lit(f.name).alias("key"), c[f.name].cast("string").alias("value")) for f in dtype]
        return _map(F.map_from_entries(F.array(*pairs)), T.MapType(T.StringType(), T.StringType()), t, zone)
    if not isinstance(dtype, T.MapType):
        return _null(t)
    key, value = t.children
    keys = _array(F.map_keys(c), T.ArrayType(dtype.keyType), _array_of(key), zone)
    values = _array(F.map_values(c), T.ArrayType(dtype.valueType), _array_of(value), zone)
    texts = F.transform(keys, lambda k: k.cast("string"))
    once = F.size(F.array_distinct(texts)) == F.size(texts)  # two spellings of one key are no map
    return F.when(keys.isNotNull() & values.isNotNull() & once, F.map_from_arrays(texts, values))


def _array_of(t: ColumnType) -> ColumnType:
    return ColumnType("Array", f"Array({t.text})", children=(t,))


def _tuple(c: Column, dtype: T.DataType, t: ColumnType, zone: str) -> Column:
    if isinstance(dtype, T.StringType):
        raw = raw_shape(t)
        # a JSON field the tuple does not have is an error, not silent loss
        unknown = F.when(F.json_object_keys(c).isNotNull(), jsontext.unknown_in(c, t, ""))
        return F.when(F.size(unknown) == 0, _tuple(F.from_json(c, raw), raw, t, zone))
    if not isinstance(dtype, T.StructType):
        return _null(t)
    given = {f.name: f.dataType for f in dtype}
    if not set(given) <= set(t.child_names):
        if len(given) != len(t.child_names):
            return _null(t)
        pairs = list(zip(given, given.values(), t.child_names, t.children, strict=True))  # by position
    else:
        pairs = [(n, given.get(n), n, child) for n, child in zip(t.child_names, t.children, strict=True)]
    fields, fits = [], F.lit(True)
    for source, dt_, name, child in pairs:
        if dt_ is None:
            fields.append(default_value(child).alias(name))
            continue
        x = c.getField(source)
        value = candidate(x, dt_, child, zone)
        fits = fits & (x.isNull() | value.isNotNull())
        fields.append(fill(x, value, child).alias(name))
    return F.when(fits & c.isNotNull(), F.struct(*fields))


def _json_value(c: Column, dtype: T.DataType, t: ColumnType, zone: str) -> Column:
    if not isinstance(dtype, T.StringType):
        return jsontext.to_json_value(c, dtype, zone)
    if t.kind in ("JSON", "Object"):
        return F.when(F.try_parse_json(c).isNotNull(), c)
    return c


def raw_shape(t: ColumnType) -> T.DataType:
    """The shape of a nested type with text leaves, for reading it from JSON text."""
    if t.kind in ("Array", "Nested"):
        return T.ArrayType(raw_shape(t.element))
    if t.kind == "Map":
        return T.MapType(T.StringType(), raw_shape(t.children[1]))
    if t.kind == "Tuple":
        pairs = zip(t.child_names, t.children, strict=True)
        return T.StructType([T.StructField(n, raw_shape(child)) for n, child in pairs])
    return T.StringType()


def within(v: Column, t: ColumnType) -> Column | None:
    """The range rule of a kind, None for a kind that takes all its Spark type holds."""
    if t.kind in INT_BOUNDS and t.kind not in WIDE_INTS:
        low, high = INT_BOUNDS[t.kind]
        return v.between(_literal(low), _literal(high))
    if t.kind == "Date":
        return v.between(F.lit(dt.date(1970, 1, 1)), F.lit(LAST_DATE))
    if t.kind == "DateTime":
        return v.between(F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(LAST_SECOND)))
    if t.kind == "DateTime64" and t.scale > 6:
        return instants.fits_64_bits(v, t.scale)
    return None


def checked(v: Column, t: ColumnType) -> Column:
    """A parsed value in its stored type, null outside the range of the kind."""
    rule = within(v, t)
    return v if rule is None else F.when(rule, v.cast(storage_type(t)))


def candidate(c: Column, dtype: T.DataType, t: ColumnType, zone: str = "UTC") -> Column:
    """The stored value of a non-null input, or null when it does not fit the type."""
    value = parsed(c, dtype, t, zone)
    return value if within(value, t) is None else text.bind(value, lambda v: checked(v, t))


def parsed(c: Column, dtype: T.DataType, t: ColumnType, zone: str) -> Column:
    """The value of a non-null input before the range rule of ``within``; null when it cannot be read."""
    kind = t.kind
    if isinstance(dtype, T.NullType):
        return _null(t)
    if isinstance(dtype, (T.VarcharType, T.CharType)):
        dtype = T.StringType()
    if kind in WIDE_INTS:
        return _wide_integer(c, dtype, t)
    if kind in INT_BOUNDS:
        return _integer(c, dtype, t)
    if kind in ("Float32", "Float64"):
        return _floating(c, dtype, t)
    if kind == "Decimal":
        return _decimal(c, dtype, t)
    if kind == "String":
        return c if isinstance(dtype, T.BinaryType) else c.cast("string")
    if kind == "FixedString":
        return _fixed_string(c, dtype, t)
    if kind == "Bool":
        return _boolean(c, dtype, t)
    if kind == "UUID":
        return _uuid(c, dtype, t)
    if kind in ("Date", "Date32"):
        return _date(c, dtype, t, zone)
    if kind in ("DateTime", "DateTime64"):
        return _date_time(c, dtype, t, zone)
    if kind in ("Enum8", "Enum16"):
        return _enum(c, dtype, t)
    if kind in ("Array", "Nested"):
        if kind == "Nested" and isinstance(dtype, T.StringType):
            dtype, c = raw_shape(t), F.from_json(c, raw_shape(t))
        return _array(c, dtype, t, zone)
    if kind == "Map":
        return _map(c, dtype, t, zone)
    if kind == "Tuple":
        return _tuple(c, dtype, t, zone)
    if kind in ("IPv4", "IPv6"):
        word = text.trim(c.cast("string"))
        return F.when(word.rlike(_IPV4 if kind == "IPv4" else _IPV6), word)
    return _json_value(c, dtype, t, zone)


def default_value(t: ColumnType) -> Column:
    """What a null becomes: null for a nullable column, else the zero of the type."""
    if t.nullable:
        return _null(t)
    kind, stored = t.kind, storage_type(t)
    if kind in ("Enum8", "Enum16"):
        return F.lit(t.enum[0][0])
    if kind in ("Date", "Date32"):
        return F.lit(dt.date(1970, 1, 1))
    if kind in ("DateTime", "DateTime64"):
        return F.timestamp_seconds(F.lit(0))
    if kind == "UUID":
        return F.lit(ZERO_UUID)
    if kind == "Bool":
        return F.lit(False)
    if kind in ("Array", "Nested"):
        return F.array().cast(stored)
    if kind == "Map":
        return F.create_map().cast(stored)
    if kind == "Tuple":
        pairs = zip(t.child_names, t.children, strict=True)
        return F.struct(*[default_value(child).alias(n) for n, child in pairs])
    if kind in ("IPv4", "IPv6"):
        return F.lit("0.0.0.0" if kind == "IPv4" else "::")
    if kind in ("JSON", "Object"):
        return F.lit("{}")
    if kind == "Decimal" and t.precision > 38:
        return F.lit("0." + "0" * t.scale if t.scale else "0")
    if kind in WIDE_INTS:
        return F.lit("0")
    if isinstance(stored, T.StringType):
        return F.lit("")
    return F.lit(0).cast(stored)


def fill(c: Column, value: Column, t: ColumnType) -> Column:
    """The converted value, with the type default in the place of a null."""
    return value if t.nullable else F.when(c.isNull(), default_value(t)).otherwise(value)


def _value_name(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return "BigDecimal"
    if isinstance(dtype, T.ArrayType):
        return "Object[]"
    return _VALUE_NAMES.get(dtype.simpleString(), type(dtype).__name__.removesuffix("Type"))


def _reason(c: Column, dtype: T.DataType, t: ColumnType) -> Column:
    """Why a value that did not convert was refused."""
    kind = t.kind
    quoted = F.concat(F.lit("'"), c.cast("string"), F.lit("'"))
    if kind in INT_BOUNDS:
        low, high = INT_BOUNDS[kind]
        if not isinstance(dtype, (*_NUMERIC, T.StringType, T.BooleanType)):
            return F.lit("cannot convert to an integer")
        shown = F.trim(c.cast("string"))
        outside = F.concat(F.lit("value "), shown, F.lit(f" is outside {low}..{high}"))
        return F.when(shown.rlike(text.WHOLE), outside).otherwise(F.concat(quoted, F.lit(" is not an integer")))
    if kind == "Decimal":
        if not isinstance(dtype, (*_NUMERIC, T.StringType)):
            return F.lit("cannot convert to a decimal")
        size = f"Decimal({t.precision}, {t.scale})"
        too_big = F.concat(F.lit("value "), c.cast("string"), F.lit(f" does not fit in {size}"))
        number = text.is_number(F.trim(c.cast("string")))
        return F.when(number, too_big).otherwise(F.concat(quoted, F.lit(" is not a number")))
    if kind == "FixedString":
        size = F.octet_length(c if isinstance(dtype, T.BinaryType) else c.cast("string"))
        return F.concat(F.lit("value of "), size.cast("string"), F.lit(f" bytes is longer than FixedString({t.precision})"))
    if kind in ("Array", "Nested"):
        plain = not isinstance(dtype, T.ArrayType)
        return F.lit("cannot convert to an array" if plain else f"an element does not fit {t.element.text}")
    if not isinstance(dtype, (T.StringType, *_NUMERIC, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(f"cannot convert to {t.text}")
    what = {
        "Float32": "a floating point number", "Float64": "a floating point number", "Bool": "a boolean",
        "UUID": "a UUID", "Date": "a date within 1970-01-01..2149-06-06", "Date32": "a date",
        "DateTime": "a timestamp within 1970-01-01..2106-02-07", "DateTime64": "a timestamp",
        "Enum8": "a declared enum value", "Enum16": "a declared enum value",
    }.get(kind, f"a {kind} value")
    return F.concat(quoted, F.lit(f" is not {what}"))


def message(c: Column, dtype: T.DataType, column: ColumnSpec) -> Column:
    """``column 'amount' (Decimal(9, 2)): 'abc' is not a number [value of type String]``"""
    head = f"column '{column.name}' ({column.type_text}): "
    return F.concat(F.lit(head), _reason(c, dtype, column.type), F.lit(f" [value of type {_value_name(dtype)}]"))


def conform_column(c: Column, dtype: T.DataType, column: ColumnSpec, zone: str = "UTC") -> tuple[Column, Column]:
    """(value, error) of one column; the error is null when the value fits."""
    converted = candidate(c, dtype, column.type, zone)
    refused = c.isNotNull() & converted.isNull()
    return fill(c, converted, column.type), F.when(refused, message(c, dtype, column))


def require_utc(df: DataFrame) -> None:
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Z", "Etc/UTC", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC for typed conversion, it is {zone}")


@lru_cache(maxsize=128)
def _conversion(fields: tuple[tuple[str, T.DataType], ...], columns: tuple[ColumnSpec, ...], zone: str) -> tuple[list[Column], ...]:
    """The columns of the three selects of ``conform``. They name their inputs, so they serve every frame of the same schema."""
    types = dict(fields)
    raw, read, narrowed, values, messages, refused = [], [], [], [], [], F.lit(False)
    for i, s in enumerate(columns):
        source, c, v = F.col(f"`{s.name}`"), F.col(f"_raw_{i}"), F.col(f"_try_{i}")
        raw.append(source.alias(f"_raw_{i}"))
        read.append(parsed(source, types[s.name], s.type, zone).alias(f"_try_{i}"))
        narrowed.append(checked(v, s.type).alias(f"_try_{i}"))
        values.append(fill(c, v, s.type).alias(s.name))
        bad = c.isNotNull() & v.isNull()
        refused = refused | bad
        messages.append(F.when(bad, message(c, types[s.name], s)))
    # Spark would push a filter on the errors below the selects and so convert every
    # value several times over. It leaves expressions alone that depend on the task,
    # hence the partition number, which is never negative.
    found = refused & (F.spark_partition_id() >= 0)
    errors = F.when(found, F.array_compact(F.array(*messages))).otherwise(F.array().cast("array<string>"))
    return [*raw, *read], [*[F.col(f"_raw_{i}") for i in range(len(columns))], *narrowed], [*values, errors.alias(ERRORS)]


def conform(df: DataFrame, columns: list[ColumnSpec], local_zone: str = "UTC", keep: list[str] | None = None) -> DataFrame:
    """Convert the columns of ``df`` named in ``columns`` to their target types.

    The result has the ``keep`` columns as they are, the converted columns in the
    order of ``columns`` and ``_errors array<string>``, empty for a clean row. A kept ``_unreadable`` becomes the row's only
    error where it is not null. Filter
    on source columns before this call: the scan cannot see a later filter.
    """
    require_utc(df)
    keep = keep or []
    types = {f.name: f.dataType for f in df.schema.fields}
    # Parse, check and report in three selects: each looks at the one before more than
    # once, and Spark keeps them apart so no value is parsed twice.
    parse, narrow, report = _conversion(tuple((s.name, types[s.name]) for s in columns), tuple(columns), local_zone)
    carried = [F.col(f"_keep_{i}") for i in range(len(keep))]
    step = df.select(*[F.col(f"`{k}`").alias(f"_keep_{i}") for i, k in enumerate(keep)], *parse)
    step = step.select(*carried, *narrow)
    done = step.select(*[c.alias(k) for c, k in zip(carried, keep, strict=True)], *report)
    if UNREADABLE not in keep:
        return done
    told = F.when(F.col(UNREADABLE).isNotNull() & (F.spark_partition_id() >= 0), F.array(UNREADABLE)).otherwise(F.col(ERRORS))
    return done.withColumn(ERRORS, told).drop(UNREADABLE)
