"""Column types of a load target, and how Spark stores them.

A target column is described by the type text its table carries (``UInt64``,
``Nullable(Decimal(18, 4))``, ``Enum8('a' = 1)``, ``Array(Array(String))`` ...).
``ColumnSpec`` holds that text on the driver; ``storage_type`` says which Spark
type keeps the converted value.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Whole-number kinds and their inclusive bounds.
INT_BOUNDS = {
    "Int8": (-(2**7), 2**7 - 1),
    "Int16": (-(2**15), 2**15 - 1),
    "Int32": (-(2**31), 2**31 - 1),
    "Int64": (-(2**63), 2**63 - 1),
    "UInt8": (0, 2**8 - 1),
    "UInt16": (0, 2**16 - 1),
    "UInt32": (0, 2**32 - 1),
    "UInt64": (0, 2**64 - 1),
    "Int128": (-(2**127), 2**127 - 1),
    "UInt128": (0, 2**128 - 1),
    "Int256": (-(2**255), 2**255 - 1),
    "UInt256": (0, 2**256 - 1),
}
WIDE_INTS = ("Int128", "UInt128", "Int256", "UInt256")

# The smallest Spark type that holds each kind.
_INT_STORAGE = {
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.DecimalType(20, 0),
}

# Digits of the sized decimal spellings, Decimal32(S) and so on.
_SIZED_DECIMALS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38, "Decimal256": 76}

# Kinds only the JSON load path accepts.
JSON_ONLY = (
    "Map", "Tuple", "Nested", "JSON", "Object", "Dynamic", "Variant", "IPv4", "IPv6",
    "Point", "Ring", "Polygon", "MultiPolygon", "LineString", "MultiLineString",
)
_SIMPLE = (
    "Float32", "Float64", "String", "Bool", "UUID", "Date", "Date32", "DateTime",
)
_OTHER = ("Decimal", "FixedString", "DateTime64", "Enum8", "Enum16", "Array")
TYPED_KINDS = frozenset([*INT_BOUNDS, *_SIMPLE, *_OTHER])


class TypeTextError(ValueError):
    """The type text of a column cannot be understood."""


@dataclass(frozen=True)
class ColumnType:
    kind: str
    text: str
    nullable: bool = False
    precision: int = 0
    scale: int = 0
    zone: str | None = None
    enum: tuple[tuple[str, int], ...] = ()
    children: tuple["ColumnType", ...] = ()
    child_names: tuple[str, ...] = ()

    @property
    def element(self) -> "ColumnType":
        return self.children[0]


@dataclass(frozen=True)
class ColumnSpec:
    """One target column. ``computed`` marks a column nobody may load into."""

    name: str
    type_text: str
    default: str | None = None
    computed: bool = False
    type: ColumnType = field(init=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "type", read_type(self.type_text))


def spec(*columns: tuple[str, str] | ColumnSpec) -> list[ColumnSpec]:
    """``spec(("id", "UInt32"), ("name", "String"))`` in table order."""
    return [c if isinstance(c, ColumnSpec) else ColumnSpec(*c) for c in columns]


def _split_args(text: str) -> list[str]:
    """Split ``a, f(b, c), 'd, e'`` on its outermost commas."""
    parts, depth, quoted, start, i = [], 0, False, 0, 0
    while i < len(text):
        ch = text[i]
        if quoted and ch == "\\":
            i += 1
        elif ch == "'":
            quoted = not quoted
        elif not quoted and ch == "(":
            depth += 1
        elif not quoted and ch == ")":
            depth -= 1
        elif not quoted and ch == "," and depth == 0:
            parts.append(text[start:i].strip())
            start = i + 1
        i += 1
    last = text[start:].strip()
    return [*parts, last] if last else parts


_ENUM_ENTRY = re.compile(r"^'((?:[^'\\]|\\.)*)'(?:\s*=\s*(-?\d+))?$", re.S)
_NAMED = re.compile(r"^(`[^`]+`|[A-Za-z_]\w*)\s+(\S.*)$", re.S)


def _enum_entries(args: list[str], text: str) -> tuple[tuple[str, int], ...]:
    entries, following = [], 1
    for arg in args:
        match = _ENUM_ENTRY.match(arg)
        if match is None:
            raise TypeTextError(f"cannot read the entry {arg!r} of {text}")
        number = following if match[2] is None else int(match[2])
        entries.append((re.sub(r"\\(.)", r"\1", match[1]), number))
        following = number + 1
    if not entries:
        raise TypeTextError(f"{text} declares no values")
    return tuple(entries)


def read_type(text: str) -> ColumnType:
    """Read one type text, e.g. ``Array(Nullable(Decimal(9, 2)))``."""
    text = text.strip()
    name, paren, rest = text.partition("(")
    name = name.strip()
    if paren and not rest.endswith(")"):
        raise TypeTextError(f"unbalanced parentheses in {text!r}")
    args = _split_args(rest[:-1]) if paren else []

    def inner(arg: str) -> ColumnType:
        return read_type(arg)

    if name == "Nullable" and len(args) == 1:
        t = inner(args[0])
        return ColumnType(**{**t.__dict__, "text": text, "nullable": True})
    if name == "LowCardinality" and len(args) == 1:
        t = inner(args[0])
        return ColumnType(**{**t.__dict__, "text": text})
    if name == "Array" and len(args) == 1:
        return ColumnType("Array", text, children=(inner(args[0]),))
    if name == "Map" and len(args) == 2:
        return ColumnType("Map", text, children=(inner(args[0]), inner(args[1])))
    if name in ("Tuple", "Nested"):
        names, children = [], []
        for i, arg in enumerate(args):
            named = _NAMED.match(arg)
            names.append(named[1].strip("`") if named else f"_{i + 1}")
            children.append(inner(named[2] if named else arg))
        row = ColumnType("Tuple", text, children=tuple(children), child_names=tuple(names))
        return row if name == "Tuple" else ColumnType("Nested", text, children=(row,))
    if name == "Decimal" and args:
        digits, scale = int(args[0]), int(args[1]) if len(args) > 1 else 0
        return ColumnType("Decimal", text, precision=digits, scale=scale)
    if name in _SIZED_DECIMALS and len(args) == 1:
        return ColumnType("Decimal", text, precision=_SIZED_DECIMALS[name], scale=int(args[0]))
    if name == "FixedString" and len(args) == 1:
        return ColumnType("FixedString", text, precision=int(args[0]))
    if name in ("DateTime", "DateTime32"):
        return ColumnType("DateTime", text, zone=args[0].strip("'") if args else None)
    if name == "DateTime64":
        scale = int(args[0]) if args else 3
        if not 0 <= scale <= 9:
            raise TypeTextError(f"{text}: the precision must be 0..9")
        return ColumnType("DateTime64", text, scale=scale, zone=args[1].strip("'") if len(args) > 1 else None)
    if name in ("Enum8", "Enum16", "Enum"):
        kind = "Enum8" if name == "Enum" else name
        return ColumnType(kind, text, enum=_enum_entries(args, text))
    if name in INT_BOUNDS or name in _SIMPLE or name in JSON_ONLY:
        return ColumnType(name, text)
    raise TypeTextError(f"unknown column type {text!r}")


def is_typed(t: ColumnType) -> bool:
    """Whether the typed load path takes the type, looking through arrays."""
    while t.kind == "Array":
        t = t.element
    return t.kind in TYPED_KINDS


def storage_type(t: ColumnType) -> T.DataType:
    """The Spark type converted values are kept in."""
    if t.kind in _INT_STORAGE:
        return _INT_STORAGE[t.kind]
    if t.kind == "Decimal":
        return T.DecimalType(t.precision, t.scale) if t.precision <= 38 else T.StringType()
    if t.kind in ("Array", "Nested"):
        return T.ArrayType(storage_type(t.element))
    if t.kind == "Map":
        return T.MapType(T.StringType(), storage_type(t.children[1]))
    if t.kind == "Tuple":
        fields = zip(t.child_names, t.children, strict=True)
        return T.StructType([T.StructField(n, storage_type(c)) for n, c in fields])
    simple = {
        "Float32": T.FloatType(),
        "Float64": T.DoubleType(),
        "Bool": T.BooleanType(),
        "Date": T.DateType(),
        "Date32": T.DateType(),
        "DateTime": T.TimestampType(),
        "DateTime64": T.TimestampType(),
    }
    return simple.get(t.kind, T.StringType())
