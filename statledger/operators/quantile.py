"""Exact order statistics without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Values that may be read by the driver at the end of a search.
FEW = 10_000
ACCURACY = 1_000


def nth_smallest(df: DataFrame, column: str, n: int, few: int = FEW) -> float | None:
    """The ``n``-th smallest value of a numeric column, counting from 1; NULLs do not count.

    Approximate percentiles on either side of the wanted rank bracket it, exact
    counts tell where in the bracket it lies, and the search goes on inside.
    Each round leaves under a hundredth of the rows, so a few rounds of plain
    aggregations do, whatever the size. Store ``df`` first if it is costly.
    """
    value = F.col(column)
    rows = df.select(value).filter(value.isNotNull())
    total = rows.count()
    if not 1 <= n <= total:
        return None
    while total > few:
        rank, reach = n / total, 3 / ACCURACY
        ends = [max(rank - reach, 0.0), min(rank + reach, 1.0)]
        low, high = rows.agg(F.percentile_approx(value, ends, ACCURACY)).first()[0]
        below, at_low, between, at_high = rows.agg(
            F.count_if(value < low),
            F.count_if(value == low),
            F.count_if((value > low) & (value < high)),
            F.count_if((value == high) & (value > low)),
        ).first()
        # The counts are exact, so a bracket that missed the rank still halves the search.
        if n <= below:
            rows, total = rows.filter(value < low), below
        elif n <= below + at_low:
            return low
        elif n <= below + at_low + between:
            rows = rows.filter((value > low) & (value < high))
            n, total = n - below - at_low, between
        elif n <= below + at_low + between + at_high:
            return high
        else:
            rows = rows.filter(value > high)
            seen = below + at_low + between + at_high
            n, total = n - seen, total - seen
    return sorted(r[0] for r in rows.collect())[n - 1]
