"""Typed, suppression-aware rows: one per natural key and version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.functions import (
    academic_year,
    aggregation_depth,
    fingerprint,
    measure_status,
    measure_value,
    natural_key,
)
from statledger.operators.dedupe import latest_extraction
from statledger.spec import TableSpec


def to_silver(
    bronze: DataFrame,
    spec: TableSpec,
    scope: str = "key",
    lenient: bool = False,
    text: bool = False,
) -> DataFrame:
    """Type the latest extraction of every version.

    ``text=True`` adds ``raw_fingerprint``, the measures as published, for
    comparisons that must see reformatting.
    """
    latest = latest_extraction(
        bronze,
        keys=(spec.version, *spec.natural_key),
        order=(spec.ingested,),
        scope=scope,
        tiebreak=tuple(spec.measures),
        load=spec.version,
    )
    start, end, label = academic_year(spec.period)
    measures = []
    for name, type_name in spec.measures.items():
        measures += [
            measure_value(name, type_name, lenient).alias(name),
            measure_status(name, spec.markers).alias(f"{name}_status"),
        ]
    typed = latest.select(
        F.col(spec.version).alias("dataset_version"),
        F.col(spec.ingested).alias("ingested_date"),
        start.alias("academic_year_start"),
        end.alias("academic_year_end"),
        label.alias("academic_year_label"),
        spec.period_kind,
        spec.area_level,
        spec.country_code,
        spec.country_name,
        F.nullif(F.col(spec.area_code), F.lit("")).alias(spec.area_code),
        F.nullif(F.col(spec.area_name), F.lit("")).alias(spec.area_name),
        *spec.dims,
        *measures,
        aggregation_depth(spec.dims, spec.total).alias("aggregation_depth"),
        *([fingerprint(tuple(spec.measures)).alias("raw_fingerprint")] if text else []),
    )
    key = natural_key(
        ("academic_year_start", spec.area_level, spec.area_code, *spec.dims),
        defaults={spec.area_code: spec.null_area},
    )
    return typed.select(
        key.alias("row_key"),
        "*",
        (F.col("aggregation_depth") == 0).alias("is_detail_grain"),
        F.col("academic_year_start").isin(*spec.provisional_years).alias("is_provisional"),
    )


def with_version(silver: DataFrame, versions: DataFrame) -> DataFrame:
    """Add publication order and date of each row's version.

    The version list is a seed of known size; Spark broadcasts it when its
    size allows.
    """
    seed = versions.select(
        F.col("version").alias("dataset_version"), "version_seq", "published_at"
    )
    return silver.join(seed, "dataset_version")
