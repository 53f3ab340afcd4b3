"""Casts for dirty input. Under ANSI mode a plain cast kills the job, so every
tolerant cast here goes through ``try_cast``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    IntegralType,
    TimestampNTZType,
    TimestampType,
)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_or_null(c: Column | str, kind: DataType | None = None) -> Column:
    """Whole number, or a decimal one rounded half away from zero; nullable counts
    written as floats (``12.0``) read as what they were. No double is involved, so all
    digits of a bigint are kept; what does not fit in one is null. ``kind`` is the
    column's type where it is known: whole numbers then are taken as they are."""
    if isinstance(kind, IntegralType):
        return _column(c).cast("bigint")
    text = _column(c).cast("string")
    rounded = F.round(text.try_cast("decimal(38,18)")).try_cast("bigint")
    return F.coalesce(text.try_cast("bigint"), rounded)


def int_or_zero(c: Column | str, kind: DataType | None = None) -> Column:
    return F.coalesce(int_or_null(c, kind), F.lit(0))


# A bare year, a year and month, or a time of day would be completed from the calendar or
# from today's date.
_FULL_DATE = r"^\s*[+-]?\d{4,6}-\d{1,2}-\d{1,2}"


def _dated(c: Column | str, kind: DataType | None) -> Column:
    c = _column(c)
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return c
    return F.when(c.cast("string").rlike(_FULL_DATE), c)


def timestamp_or_null(c: Column | str, kind: DataType | None = None) -> Column:
    """Time of a value that states a full date."""
    return _dated(c, kind).try_cast("timestamp")


def date_or_null(c: Column | str, kind: DataType | None = None) -> Column:
    """The value's own calendar date: an offset in the text does not shift it."""
    return _dated(c, kind).try_cast("date")


def flag(c: Column | str, kind: DataType | None = None) -> Column:
    """Boolean with null, or text that is no boolean, read as false."""
    return F.coalesce(_column(c) if isinstance(kind, BooleanType) else _column(c).try_cast("boolean"), F.lit(False))


def strict_cast(c: Column | str, dtype: DataType, label: str) -> Column:
    """Cast that aborts the job on the first bad value, whatever the ANSI setting."""
    c = _column(c)
    cast = c.try_cast(dtype)
    bad = F.concat(F.lit(f"cannot load {label}: "), c.cast("string"))
    return F.when(c.isNotNull() & cast.isNull(), F.raise_error(bad).cast(dtype)).otherwise(cast)
