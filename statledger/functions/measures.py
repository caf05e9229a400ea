"""Split a published text cell into a typed value and the reason it may be absent."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from statledger.spec import MARKERS, MISSING, PUBLISHED, UNRECOGNISED

# SQL trim() strips spaces only; published files also pad with tabs and no-break spaces.
WHITESPACE = " \t\n\r\x0b\x0c\x85\xa0"

# Engines disagree on '4d', 'NaN' and 'inf'. A cell is a number only if it looks like one.
INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _trimmed(c: Column | str) -> Column:
    return F.btrim(_column(c), F.lit(WHITESPACE))


def measure_value(c: Column | str, type_name: str = "bigint", lenient: bool = False) -> Column:
    """Typed value of a text cell; NULL when withheld, blank or not of the type.

    ``'4.0'`` in an integer measure is NULL by default and 4 with ``lenient``.
    """
    text = _trimmed(c)
    if type_name == "double":
        return F.when(text.rlike(NUMBER), text).try_cast("double")
    strict = F.when(text.rlike(INTEGER), text).try_cast(type_name)
    if not lenient:
        return strict
    number = F.when(text.rlike(NUMBER), text).try_cast("double")
    whole = F.when(number == F.floor(number), number).try_cast(type_name)
    return F.coalesce(strict, whole)


def measure_status(c: Column | str, markers: Mapping[str, str] = MARKERS) -> Column:
    """Why a text cell has or lacks a value; markers match in any case."""
    text = _trimmed(c)
    status = F.when(text.isNull() | (text == ""), MISSING).when(text.rlike(NUMBER), PUBLISHED)
    for marker, meaning in markers.items():
        status = status.when(F.lower(text) == marker.lower(), meaning)
    return status.otherwise(UNRECOGNISED)


def safe_divide(a: Column, b: Column) -> Column:
    """Quotient as double; NULL on a zero or NULL denominator."""
    return F.try_divide(a, b).cast("double")


def per_mille(part: Column, whole: Column) -> Column:
    """Share in thousandths, rounded half up in whole numbers; NULL for an empty whole.

    Whole-number rounding gives the same figure in every engine, which
    rounding a double does not.
    """
    doubled = F.nullif(2 * whole, F.lit(0))
    return F.floor(F.try_divide(2000 * part + whole, doubled)).cast("bigint")
