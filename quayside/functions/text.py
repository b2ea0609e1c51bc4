"""Exact number text on the JVM, for values wider than any Spark number.

Spark decimals stop at 38 digits. These helpers work on the digits themselves,
so 256-bit integers and 76-digit decimals need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters trimmed around a value, U+0000..U+0020.
BLANKS = "".join(chr(c) for c in range(0x21))

# sign, whole digits, fraction digits, exponent
_NUMBER = r"^([+-]?)([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]+))?$"
# More zeros than any supported number has digits: longer shifts only mean "too big".
_MAX_SHIFT = 200

# a whole number spelled without exponent
WHOLE = r"^[+-]?[0-9]+(\.0*)?$"


def trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def bind(c: Column, f) -> Column:
    """``f`` applied to ``c`` once computed, however often ``f`` mentions it.

    Spark interprets the inside of an array expression. That suits the branches
    few rows take: their long expressions stay out of the generated code of the
    common path, and none of their inputs is computed twice.
    """
    return F.transform(F.array(c), f).getItem(0)


def _parts(text: Column) -> Column:
    """Sign, digits without leading zeros and power of ten of a number text."""
    whole, fraction, exponent = (F.regexp_extract(text, _NUMBER, g) for g in (2, 3, 4))
    power = F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("int")) - F.length(fraction)
    return F.struct(
        F.when(F.regexp_extract(text, _NUMBER, 1) == "-", F.lit("-")).otherwise(F.lit("")).alias("sign"),
        F.ltrim(F.concat(whole, fraction), F.lit("0")).alias("digits"),
        power.alias("power"),
    )


def is_number(text: Column) -> Column:
    """Whether trimmed text is spelled like a decimal number."""
    return text.rlike(_NUMBER) & text.rlike(r"^[+-]?\.?[0-9]")


def _zeros(n: Column) -> Column:
    return F.repeat(F.lit("0"), F.greatest(F.least(n, F.lit(_MAX_SHIFT)), F.lit(0)))


def integer_text(c: Column) -> Column:
    """Canonical digits of a whole number (``"1.0"`` -> ``1``, ``"1e3"`` -> ``1000``); null for anything else."""

    def whole(p: Column) -> Column:
        sign, digits, power = p.getField("sign"), p.getField("digits"), p.getField("power")
        size = F.length(digits)
        longer = F.concat(sign, digits, _zeros(power))
        shorter = F.concat(sign, F.substring(digits, F.lit(1), F.greatest(size + power, F.lit(0))))
        exact = F.length(F.rtrim(digits, F.lit("0"))) <= size + power
        return (
            F.when(power.isNull(), F.lit(None).cast("string"))
            .when(digits == "", F.lit("0"))
            .when(power >= 0, longer)
            .when(exact, shorter)
        )

    return bind(trim(c), lambda t: F.when(is_number(t), bind(_parts(t), whole)))


def within_bounds(digits: Column, low: int, high: int) -> Column:
    """Whether canonical integer text lies in ``low..high``."""

    def at_most(magnitude: Column, bound: int) -> Column:
        limit = str(bound)
        shorter = F.length(magnitude) < len(limit)
        return shorter | ((F.length(magnitude) == len(limit)) & (magnitude <= limit))

    negative = digits.startswith("-")
    return F.when(negative, at_most(F.substring(digits, F.lit(2), F.length(digits)), -low)).otherwise(
        at_most(digits, high)
    )


def _plus_one(digits: Column) -> Column:
    """Add one to non-negative digits text."""
    nines = F.regexp_extract(digits, "9*$", 0)
    head = F.substring(digits, F.lit(1), F.length(digits) - F.length(nines))
    zeros = F.repeat(F.lit("0"), F.length(nines))
    bumped = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.translate(F.right(head, F.lit(1)), "012345678", "123456789"),
        zeros,
    )
    return F.when(head == "", F.concat(F.lit("1"), zeros)).otherwise(bumped)


def decimal_text(c: Column, precision: int, scale: int) -> Column:
    """Number text rounded half up to ``scale`` places; null when it is no number or needs more digits than ``precision``."""

    def unscaled(p: Column) -> Column:
        digits, shift = p.getField("digits"), p.getField("power") + F.lit(scale)
        size = F.length(digits)
        kept = F.substring(digits, F.lit(1), F.greatest(size + shift, F.lit(0)))
        dropped = F.when(size + shift >= 0, F.substring(digits, size + shift + 1, F.lit(1))).otherwise(F.lit("0"))
        rounded = (
            F.when(digits == "", F.lit(""))
            .when(shift >= 0, F.concat(digits, _zeros(shift)))
            .when(dropped >= "5", bind(kept, _plus_one))
            .otherwise(kept)
        )
        return F.when(shift.isNotNull(), F.struct(p.getField("sign").alias("sign"), rounded.alias("digits")))

    def plain(u: Column) -> Column:
        sign, digits = u.getField("sign"), u.getField("digits")
        padded = F.when(F.length(digits) > scale, digits).otherwise(F.lpad(digits, scale + 1, "0"))
        whole = F.substring(padded, F.lit(1), F.length(padded) - scale)
        shown = F.concat(whole, F.lit("."), F.right(padded, F.lit(scale))) if scale else whole
        signed = F.when(digits == "", shown).otherwise(F.concat(sign, shown))
        return F.when(F.length(digits) <= precision, signed)

    return bind(trim(c), lambda t: F.when(is_number(t), bind(bind(_parts(t), unscaled), plain)))
