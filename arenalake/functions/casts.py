"""Casts that give NULL for malformed text, whatever the ANSI setting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole part of a plain decimal number; exponents do not match.
_WHOLE_PART = r"^([+-]?[0-9]+)(\.[0-9]*)?$"


def to_int(column, legacy: bool = False) -> Column:
    """Text to int. ``legacy`` truncates ``3.7`` to 3 instead of giving NULL."""
    column = _column(column)
    if legacy:
        column = F.regexp_extract(F.trim(column), _WHOLE_PART, 1)
    return column.try_cast("int")


def to_day(column) -> Column:
    return _column(column).try_cast("date")


def to_instant(column) -> Column:
    return _column(column).try_cast("timestamp")


def parse_day(column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text in ``pattern`` to date; a date passes through."""
    return F.try_to_date(_column(column), pattern)


def month_of(day) -> Column:
    return F.date_format(_column(day), "yyyy-MM")


def _column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column
