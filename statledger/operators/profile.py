"""Profiles that show how a published table misleads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.functions import aggregation_depth, measure_status, measure_value, safe_divide
from statledger.spec import STATUSES, TableSpec


def _stacked(rows: Sequence[Sequence[Column]], names: Sequence[str]) -> Column:
    flat = [c for row in rows for c in row]
    return F.stack(F.lit(len(rows)), *flat).alias(*names)


def double_count_proof(df: DataFrame, spec: TableSpec, by: Sequence[str] = ()) -> DataFrame:
    """Total of the headline count summed naively, over detail only, and as published.

    ``df`` holds text measures, one row per natural key (``latest_extraction``);
    the three totals come from one aggregation.
    """
    depth = aggregation_depth(spec.dims, spec.total)
    scored = df.select(
        *by,
        measure_value(spec.headline).alias("starts"),
        depth.alias("depth"),
    )
    official = F.col("depth") == len(spec.dims)
    detail = F.col("depth") == 0
    # Row labels of the report.
    methods: Mapping[str, Column] = {
        "NAIVE  SUM(all rows)": F.lit(True),
        "CORRECT detail grain only": detail,
        "OFFICIAL published total": official,
    }
    sums = [
        (F.sum(F.when(p, F.col("starts"))).alias(f"s{i}"), F.count_if(p).alias(f"n{i}"))
        for i, p in enumerate(methods.values())
    ]
    totals = scored.groupBy(*by).agg(*[c for pair in sums for c in pair])
    rows = [[F.lit(m), F.col(f"s{i}"), F.col(f"n{i}")] for i, m in enumerate(methods)]
    return totals.select(*by, _stacked(rows, ("method", "total_starts", "rows_used"))).orderBy(
        *by, F.col("total_starts").desc_nulls_last()
    )


def depth_histogram(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per aggregation depth."""
    return df.groupBy(*by, "aggregation_depth").agg(F.count("*").alias("row_count"))


def marker_profile(df: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Cells and share per status of every measure, from one aggregation."""
    counts = {
        (m, s): F.count_if(F.col(f"{m}_status") == s).alias(f"{m}:{s}")
        for m in measures
        for s in STATUSES
    }
    totals = df.groupBy(*by).agg(F.count("*").alias("_n"), *counts.values())
    rows = [[F.lit(m), F.lit(s), F.col(f"`{m}:{s}`")] for m, s in counts]
    return (
        totals.select(*by, "_n", _stacked(rows, ("measure", "status", "cells")))
        .filter("cells > 0")
        .select(
            *by,
            "measure",
            "status",
            "cells",
            safe_divide(F.col("cells"), F.col("_n")).alias("share"),
        )
    )


def rounding_check(df: DataFrame, measures: Sequence[str], base: int = 10) -> DataFrame:
    """Whether every published figure of a count is a multiple of ``base``."""
    aggregates = []
    for m in measures:
        aggregates += [
            F.count(m).alias(f"{m}:n"),
            F.count_if(F.col(m) % base == 0).alias(f"{m}:ok"),
            F.min(m).alias(f"{m}:min"),
        ]
    rows = [
        [
            F.lit(m),
            F.col(f"`{m}:n`"),
            F.col(f"`{m}:ok`"),
            F.col(f"`{m}:min`"),
            F.col(f"`{m}:n`") == F.col(f"`{m}:ok`"),
        ]
        for m in measures
    ]
    names = ("measure", "published_values", "rounded_values", "min_value", "all_rounded")
    return df.agg(*aggregates).select(_stacked(rows, names))


def status_counts(df: DataFrame, measures: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Marker profile straight from text cells, with the sum of the typed values."""
    typed = df.select(
        *by,
        *[measure_value(m, t).alias(m) for m, t in measures.items()],
        *[measure_status(m).alias(f"{m}_status") for m in measures],
    )
    counts = {
        (m, s): (
            F.count_if(F.col(f"{m}_status") == s).alias(f"{m}:{s}"),
            F.sum(F.when(F.col(f"{m}_status") == s, F.col(m))).cast("double").alias(f"{m}:{s}:sum"),
        )
        for m in measures
        for s in STATUSES
    }
    totals = typed.groupBy(*by).agg(*[c for pair in counts.values() for c in pair])
    rows = [
        [F.lit(m), F.lit(s), F.col(f"`{m}:{s}`"), F.col(f"`{m}:{s}:sum`")] for m, s in counts
    ]
    names = ("measure", "status", "cells", "value_sum")
    return totals.select(*by, _stacked(rows, names)).filter("cells > 0")


def reconcile(
    fact: DataFrame,
    spec: TableSpec,
    by: Sequence[str] = ("academic_year_start",),
    area_level: str | None = None,
    tolerance: float = 0.001,
) -> DataFrame:
    """Detail sum against the published total of each group.

    Figures are rounded one by one, so the two cannot be equal; the relative
    error is compared with ``tolerance``. Both sides come from one aggregation.
    Groups need detail rows and a published total.
    """
    value = F.col(spec.headline)
    detail = F.col("is_detail_grain")
    official = (F.col("aggregation_depth") == len(spec.dims)) & value.isNotNull()
    rows = fact.filter("is_current").filter(
        F.col(spec.area_level) == (area_level or spec.national)
    )
    sides = (
        rows.filter(detail | official)
        .groupBy(*by)
        .agg(
            F.sum(F.when(detail, value)).alias("detail_starts"),
            F.max(F.when(official, value)).alias("published_starts"),
            F.count_if(detail).alias("_details"),
        )
        .filter("published_starts IS NOT NULL AND _details > 0")
    )
    error = safe_divide(
        F.abs(F.col("detail_starts") - F.col("published_starts")), F.col("published_starts")
    )
    return sides.select(
        *by,
        "detail_starts",
        "published_starts",
        (F.col("detail_starts") - F.col("published_starts")).alias("difference"),
        error.alias("rel_error"),
        (error <= tolerance).alias("within_tolerance"),
    )
