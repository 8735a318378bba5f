"""Scalar expressions with the reference's SQL semantics.

``DATEDIFF(unit, a, b)`` in the reference counts unit *boundaries* crossed between
``a`` and ``b`` (00:00:59 -> 00:30:00 is 30 minutes), whereas Spark's
``timestampdiff`` counts whole elapsed units (29). ``boundary_diff`` reproduces the
boundary count without depending on the session time zone: both instants are
measured in microseconds from a fixed zone-free origin that is itself on every
boundary, floored to the unit, and subtracted.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Micro-seconds per unit for the sub-day units the reference uses.
_UNIT_MICROS = {
    "SECOND": 1_000_000,
    "MINUTE": 60_000_000,
    "HOUR": 3_600_000_000,
}

# Origin on every second/minute/hour/day boundary and before any plausible birth
# date, so floor division of a non-negative offset is plain integer division.
_ORIGIN = "0001-01-01 00:00:00"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _micros_since_origin(c: ColumnOrName) -> Column:
    origin = F.lit(_ORIGIN).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", origin, _col(c).cast("timestamp_ntz"))


def boundary_diff(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end`` (bigint).

    ``unit`` is SECOND, MINUTE, HOUR, DAY or YEAR. NULL in, NULL out.
    """
    unit = unit.upper()
    if unit == "DAY":
        return day_diff(start, end)
    if unit == "YEAR":
        return (F.year(_col(end)) - F.year(_col(start))).cast("bigint")
    size = F.lit(_UNIT_MICROS[unit]).cast("bigint")
    # Integral (exact) division; offsets are non-negative, so it is a floor.
    return (F.call_function("div", _micros_since_origin(end), size)
            - F.call_function("div", _micros_since_origin(start), size))


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Day boundaries crossed (calendar days between the two dates), bigint."""
    return F.datediff(_col(end).cast("date"), _col(start).cast("date")).cast("bigint")


def year_of(c: ColumnOrName) -> Column:
    """Calendar year as bigint (the reference's YEAR/DATEPART(YEAR))."""
    return F.year(_col(c)).cast("bigint")


def hours_from_minutes(minutes: ColumnOrName) -> Column:
    """``minutes / 60.`` with the reference's exact decimal type: decimal(16,6)."""
    return _col(minutes).cast("int") / F.lit(Decimal("60"))


def ntz(value) -> Column:
    """A zone-free timestamp literal from a ``datetime``/``date``/ISO string.

    (``F.lit(datetime)`` would build a zoned timestamp via the Python process's
    local zone; going through the ISO text keeps the wall-clock value exact.)
    """
    text = value if isinstance(value, str) else value.isoformat(sep=" ") \
        if hasattr(value, "hour") else value.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def typed_null(data_type: str) -> Column:
    """A NULL of an explicit type (union branches must agree on types)."""
    return F.lit(None).cast(data_type)


def status_ok(c: ColumnOrName, values: list[str]) -> Column:
    """``c IN (values) OR c IS NULL``: accept listed codes and missing ones."""
    col = _col(c)
    return col.isin(list(values)) | col.isNull()


def flag(condition: Column) -> Column:
    """'1'/'0' string flag; a NULL condition gives '0' (ELSE branch)."""
    return F.when(condition, F.lit("1")).otherwise(F.lit("0"))


def min_text(col: str | Column, collation: str) -> Column:
    """The least text in the order of ``collation`` (e.g. ``UNICODE``: linguistic, case- and
    accent-sensitive), as a plain string. Texts that the collation cannot tell apart (only
    canonically equivalent spellings, under ``UNICODE``) come out in binary order."""
    c = F.col(col) if isinstance(col, str) else col
    plain = F.collate(c, "UTF8_BINARY")
    if collation == "UTF8_BINARY":
        return F.min(plain)
    ranked = F.struct(F.collate(c, collation).alias("rank"), plain.alias("text"))
    return F.min(F.when(c.isNotNull(), ranked)).getField("text")
