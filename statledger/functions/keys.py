"""Keys, periods and grain of a published row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def aggregation_depth(dims: Sequence[str], total: str = "Total") -> Column:
    """How many dimensions are rolled up on the row; 0 is detail."""
    return reduce(add, [F.when(F.col(d) == total, 1).otherwise(0) for d in dims])


def natural_key(cols: Sequence[str], defaults: Mapping[str, str] | None = None) -> Column:
    """Hex MD5 over the ``|``-joined key columns.

    A NULL in a column without a default makes the key NULL, so that the
    not-null check reports the row; ``concat_ws`` would drop the part silently.
    """
    defaults = defaults or {}
    parts: list[Column] = []
    for name in cols:
        part = F.col(name).cast("string")
        if name in defaults:
            part = F.coalesce(part, F.lit(defaults[name]))
        parts += [F.lit("|"), part]
    return F.md5(F.concat(*parts[1:]))


def academic_year(period: Column | str) -> tuple[Column, Column, Column]:
    """``'202425'`` as start year 2024, end year 2025 and label ``2024/25``."""
    p = F.col(period) if isinstance(period, str) else period
    start = F.substring(p, 1, 4)
    label = F.concat(start, F.lit("/"), F.substring(p, 5, 2))
    return start.cast("bigint"), start.cast("bigint") + 1, label


def fingerprint(cols: Sequence[str]) -> Column:
    """The raw cells joined by ``~``, a NULL cell as the control character NUL."""
    parts: list[Column] = []
    for name in cols:
        parts += [F.lit("~"), F.coalesce(F.col(name), F.lit("\x00"))]
    return F.concat(*parts[1:])
