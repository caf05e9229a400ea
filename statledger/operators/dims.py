"""Conformed dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statledger.functions import natural_key
from statledger.spec import TableSpec

# Meaning of each measure status.
SUPPRESSION_STATUS = (
    ("published", "Published", True, "Figure is published and usable."),
    (
        "suppressed_low",
        "Suppressed (low)",
        False,
        "Value too small to publish without risking disclosure of an individual.",
    ),
    (
        "suppressed_confidential",
        "Suppressed (confidential)",
        False,
        "Withheld for confidentiality reasons.",
    ),
    (
        "not_applicable",
        "Not applicable",
        False,
        "This measure is not collected for this breakdown.",
    ),
    ("missing", "Missing", False, "Absent from the source with no marker given."),
    (
        "unrecognised",
        "Unrecognised marker",
        False,
        "A marker not seen during profiling. Investigate before using.",
    ),
)


def dim_academic_year(silver: DataFrame) -> DataFrame:
    """One row per academic year, the newest one flagged."""
    years = silver.select(
        "academic_year_start", "academic_year_end", "academic_year_label", "is_provisional"
    ).distinct()
    newest = silver.agg(F.max("academic_year_start")).scalar()
    return years.select(
        F.col("academic_year_start").alias("academic_year_key"),
        "*",
        (F.col("academic_year_start") == newest).alias("is_latest_year"),
    )


def dim_geography(silver: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per area; the residual flag is NULL where the area has no name."""
    areas = silver.select(
        spec.area_level, spec.country_code, spec.country_name, spec.area_code, spec.area_name
    ).distinct()
    key = natural_key((spec.area_level, spec.area_code), {spec.area_code: spec.null_area})
    return areas.select(
        key.alias("geography_key"),
        "*",
        F.coalesce(spec.area_name, spec.country_name).alias("display_name"),
        (F.col(spec.area_name) == spec.residual_area).alias("is_residual_bucket"),
    )


def dim_suppression_status(spark: SparkSession) -> DataFrame:
    """The six statuses a cell can have."""
    return spark.createDataFrame(
        SUPPRESSION_STATUS,
        "status_code string, status_label string, has_value boolean, explanation string",
    )


def suppression_status_usage(silver: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Every status with its meaning and how many cells of ``silver`` carry it."""
    counted = silver.agg(
        *[
            reduce(add, [F.count_if(F.col(f"{m}_status") == code) for m in measures]).alias(code)
            for code, *_ in SUPPRESSION_STATUS
        ]
    )
    cells = counted.select(
        F.stack(
            F.lit(len(SUPPRESSION_STATUS)),
            *[c for code, *_ in SUPPRESSION_STATUS for c in (F.lit(code), F.col(code))],
        ).alias("status_code", "cells")
    )
    return dim_suppression_status(silver.sparkSession).join(cells, "status_code")
