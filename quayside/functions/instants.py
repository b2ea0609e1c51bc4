"""Text and numbers to instants. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import bind, trim

_DAY_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?"
_ISO = _DAY_TIME + r"(Z|[+-][0-9]{2}:[0-9]{2})?$"
# Spellings the ISO standard also allows: no seconds, small letters, a region after the offset.
_LOOSE = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2})[Tt ]([0-9]{2}:[0-9]{2})(:[0-9]{2}(?:\.[0-9]{1,9})?)?"
    r"(?:([Zz]|[+-][0-9]{2}:[0-9]{2})(?:\[[A-Za-z][A-Za-z0-9~/._+-]*\])?)?$"
)
# Fixed value: the seconds a 64-bit count of microseconds can reach.
_MAX_SECONDS = 9223372036854


def _in_zone(local: Column, zone: str) -> Column:
    """A wall-clock time written as if it were UTC, read in ``zone`` instead."""
    return local if zone == "UTC" else F.to_utc_timestamp(local, zone)


def from_text(text: Column, zone: str) -> Column:
    """ISO date-time text to an instant; null when it is not one. Text without an offset is read in ``zone``."""

    def loose(t: Column) -> Column:
        seconds = F.regexp_extract(t, _LOOSE, 3)
        offset = F.upper(F.regexp_extract(t, _LOOSE, 4))
        full = F.concat(
            F.regexp_extract(t, _LOOSE, 1), F.lit("T"), F.regexp_extract(t, _LOOSE, 2),
            F.when(seconds == "", F.lit(":00")).otherwise(seconds),
        )
        local = _in_zone(F.concat(full, F.lit("Z")).try_cast("timestamp"), zone)
        either = F.when(offset == "", local).otherwise(F.concat(full, offset).try_cast("timestamp"))
        return F.when(t.rlike(_LOOSE), either)

    # The usual spelling costs one pattern and one cast. Blanks and rare spellings
    # take the other branch. Spark's own cast is too lenient without the pattern.
    zoned = text.endswith("Z") | F.substring(text, -6, 1).isin("+", "-")
    local = _in_zone(F.concat(text, F.lit("Z")).try_cast("timestamp"), zone)
    usual = F.when(zoned, text.try_cast("timestamp")).otherwise(local)
    return F.when(text.rlike(_ISO), usual).otherwise(bind(trim(text), loose))


def from_local(c: Column, zone: str) -> Column:
    """A timestamp without zone, read in ``zone``."""
    return _in_zone(c.cast("timestamp"), zone)


def from_seconds(c: Column, fractional: bool) -> Column:
    """Seconds since 1970, below zero too; fractions are floored to microseconds."""
    if not fractional:
        seconds = c.cast("bigint")
        return F.when(seconds.between(-_MAX_SECONDS, _MAX_SECONDS), F.timestamp_seconds(seconds))
    exact = c.try_cast("decimal(38,15)")
    return F.when(
        exact.between(F.lit(-_MAX_SECONDS), F.lit(_MAX_SECONDS)),
        F.floor(exact, F.lit(6)).cast("timestamp"),
    )


def floor_to(c: Column, digits: int) -> Column:
    """Cut an instant down to ``digits`` fractional digits (Spark keeps six)."""
    if digits >= 6:
        return c
    if digits in (0, 3):
        return F.date_trunc({0: "second", 3: "millisecond"}[digits], c)
    micros = F.unix_micros(c)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(10 ** (6 - digits))))


def fits_64_bits(c: Column, digits: int) -> Column:
    """Whether the instant, counted in units of ``digits`` fractional digits, fits a 64-bit number."""
    if digits <= 6:
        return F.lit(True)
    top = 2**63 - 1
    low = -(2**63 // 10**digits) * 10**6
    return F.unix_micros(c).between(low, top // 10 ** (digits - 6))
