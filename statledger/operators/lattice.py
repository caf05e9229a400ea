"""Published subtotals as a lattice: what they must add up to, and what they give away about withheld cells.

A cell is one row per ``by`` and ``dims``; a dimension that holds the total member is summed over. Counts are whole
numbers published rounded, so a figure is off by at most half its base, and a sum of n figures by n times that.
A withheld cell lies between 0 and the ceiling of its status, or has no upper bound.

Defined cases: NULL members and NULL scopes are members and scopes like others. Cells that the table lacks count as 0.
A table without rows gives none. A subtotal without a figure is left out of the reconciliation. Repeated
rows of a cell would count twice, so one row per cell is what callers pass, as current records are. Columns named like
those added (``published`` to ``verdict``, ``least`` to ``revealed``) may not be among ``by`` and ``dims``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.spec import PUBLISHED

HOLDS, ABOVE, BELOW = "holds", "above detail", "below detail"


def _depth(dims: Sequence[str], total: str) -> Column:
    return reduce(Column.__add__, [F.when(F.col(d) == total, 1).otherwise(0) for d in dims])


def _limits(value: str, status: str, ceilings: Mapping[str, int], base: int) -> tuple[Column, Column]:
    """The least and greatest count that a cell can stand for; the latter NULL without a bound."""
    shown, half = F.col(value), F.lit(base // 2).cast("bigint")
    most = F.when(shown.isNotNull(), shown + half)
    for name, ceiling in ceilings.items():
        most = most.when(F.col(status) == name, F.lit(ceiling).cast("bigint"))
    return F.coalesce(F.greatest(shown - half, F.lit(0)), F.lit(0)).cast("bigint"), most


def reconcile_lattice(
    cells: DataFrame,
    dims: Sequence[str],
    by: Sequence[str],
    value: str,
    status: str,
    total: str = "Total",
    ceilings: Mapping[str, int] | None = None,
    base: int = 10,
) -> DataFrame:
    """Every published subtotal, in all grouping sets, against the detail cells below it.

    One expansion deals each detail cell to its subtotals and one aggregation, combined before the shuffle, brings
    them together with the published figures. ``least`` and ``most`` bound the true sum of the detail, and the verdict
    says whether the published figure, give or take its own rounding, can be that sum.
    """
    least, most = _limits(value, status, ceilings or {}, base)
    own = F.struct(*[F.col(d).alias(d) for d in dims])
    above = [
        F.struct(*[(F.lit(total) if up else F.col(d)).alias(d) for d, up in zip(dims, ups, strict=True)])
        for ups in product((False, True), repeat=len(dims))
        if any(ups)
    ]
    depth = _depth(dims, total)
    dealt = cells.where((depth == 0) | F.col(value).isNotNull()).select(
        *by,
        (depth == 0).alias("_detail"),
        F.col(value).alias("_value"),
        least.alias("_least"),
        most.alias("_most"),
        F.explode(F.when(depth == 0, F.array(*above)).otherwise(F.array(own))).alias("_cell"),
    )
    detail = F.col("_detail")

    def summed(c: Column) -> Column:
        return F.coalesce(F.sum(F.when(detail, c)), F.lit(0)).cast("bigint")

    sums = dealt.groupBy(*by, *[F.col(f"_cell.{d}").alias(d) for d in dims]).agg(
        F.max(F.when(~detail, F.col("_value"))).alias("published"),
        F.count_if(detail).alias("detail_cells"),
        F.count_if(detail & F.col("_value").isNull()).alias("withheld_cells"),
        summed(F.col("_value")).alias("detail_sum"),
        summed(F.col("_least")).alias("least"),
        F.when(F.count_if(detail & F.col("_most").isNull()) == 0, summed(F.col("_most"))).alias("most"),
    )
    figure, half = F.col("published"), base // 2
    return sums.where("published IS NOT NULL").withColumn(
        "verdict",
        F.when(figure - half > F.col("most"), ABOVE).when(figure + half < F.col("least"), BELOW).otherwise(HOLDS),
    )


def check_lattice(*args, **named) -> DataFrame:
    """Subtotals that their detail cannot add up to."""
    return reconcile_lattice(*args, **named).where(F.col("verdict") != HOLDS)


def _tightened(cells: DataFrame, dims: Sequence[str], d: str, by: Sequence[str], total: str) -> DataFrame:
    """Bounds after one look along ``d``: a total is the sum of its members, and a member the total less the others.

    A line whose bounds contradict each other changes nothing.
    """
    line = Window.partitionBy(*by, *[x for x in dims if x != d])
    parent = F.coalesce(F.col(d) == total, F.lit(False))
    low, high = F.col("least"), F.col("most")
    seen = cells.withColumns(
        {
            "_total_low": F.max(F.when(parent, low)).over(line),
            "_total_high": F.max(F.when(parent, high)).over(line),
            "_low": F.coalesce(F.sum(F.when(~parent, low)).over(line), F.lit(0)),
            "_high": F.coalesce(F.sum(F.when(~parent, high)).over(line), F.lit(0)),
            "_open": F.count_if(~parent & high.isNull()).over(line),
        }
    )
    total_low, total_high = F.col("_total_low"), F.col("_total_high")
    members = F.when(F.col("_open") == 0, F.col("_high"))
    against = F.coalesce(total_high < F.col("_low"), F.lit(False)) | F.coalesce(members < total_low, F.lit(False))
    others_open = F.col("_open") - F.when(high.isNull(), 1).otherwise(0)
    others_high = F.when(others_open == 0, F.col("_high") - F.coalesce(high, F.lit(0)))
    new_low = F.when(parent, F.greatest(low, F.col("_low"))).otherwise(F.greatest(low, total_low - others_high))
    new_high = F.when(parent, F.least(high, members)).otherwise(F.least(high, total_high - (F.col("_low") - low)))
    # Without a total in the line nothing is known of its sum.
    stays = total_low.isNull() | against
    return seen.withColumns(
        {
            "least": F.when(stays, low).otherwise(new_low).cast("bigint"),
            "most": F.when(stays, high).otherwise(new_high).cast("bigint"),
        }
    ).drop("_total_low", "_total_high", "_low", "_high", "_open")


def withheld_bounds(
    cells: DataFrame,
    dims: Sequence[str],
    by: Sequence[str],
    value: str,
    status: str,
    total: str = "Total",
    ceilings: Mapping[str, int] | None = None,
    base: int = 10,
    rounds: int = 2,
) -> DataFrame:
    """What a reader can work out about every withheld cell by adding and subtracting published ones.

    Intervals are narrowed along each dimension in turn, ``rounds`` times; more rounds can only narrow further. A cell is
    revealed when its interval is no wider than a published figure's. Cells dealt by the scope and one dimension
    serve the lines of all other dimensions, so a round takes two shuffles and not one for each dimension.
    """
    least, most = _limits(value, status, ceilings or {}, base)
    known = cells.select(*by, *dims, F.col(status).alias("status"), least.alias("least"), most.alias("most"))
    known = known.withColumns({"least_alone": F.col("least"), "most_alone": F.col("most")})
    first, last = dims[0], dims[-1]
    for _ in range(rounds):
        if len(dims) > 1:
            known = known.repartition(*by, last)
            for d in dims[:-1]:
                known = _tightened(known, dims, d, by, total)
            known = known.repartition(*by, first)
        known = _tightened(known, dims, last, by, total)
    width = F.col("most") - F.col("least")
    narrowed = (F.col("least") > F.col("least_alone")) | ~F.col("most").eqNullSafe(F.col("most_alone"))
    return known.where(F.coalesce(F.col("status") != PUBLISHED, F.lit(True))).select(
        *by,
        *dims,
        "status",
        "least",
        "most",
        narrowed.alias("narrowed"),
        F.coalesce(width <= 2 * (base // 2), F.lit(False)).alias("revealed"),
    )


def disclosure_report(bounds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Withheld cells per group, and how many of them subtraction narrows or reveals."""
    return bounds.groupBy(*by).agg(
        F.count("*").alias("withheld_cells"),
        F.count_if("narrowed").alias("narrowed_cells"),
        F.count_if("revealed").alias("revealed_cells"),
    )
