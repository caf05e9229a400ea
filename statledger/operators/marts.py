"""Marts over the current, detail-grain part of a history, and dashboard feeds."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.functions import per_mille, safe_divide
from statledger.spec import PUBLISHED, UNRECOGNISED, TableSpec

YEAR = ("academic_year_start", "academic_year_label", "is_provisional")


def detail_current(fact: DataFrame, area_level: tuple[str, str] | None = None) -> DataFrame:
    """The rows that may be summed: current, no subtotals, one area level if given."""
    rows = fact.filter("is_current AND is_detail_grain")
    if area_level:
        column, member = area_level
        rows = rows.filter(F.col(column) == member)
    return rows


def regional_trends(fact: DataFrame, spec: TableSpec) -> DataFrame:
    """Sums per year, region and level, with the number of cells withheld.

    A group whose cells are all withheld sums to NULL, never to 0.
    """
    withheld = F.count_if(F.col(spec.headline_status) != PUBLISHED)
    return (
        detail_current(fact, (spec.area_level, spec.regional))
        .groupBy(*YEAR, spec.area_code, spec.area_name, spec.level)
        .agg(
            F.sum(spec.headline).alias("starts"),
            F.sum(spec.outcome).alias("achievements"),
            F.sum(spec.activity).alias("participation"),
            F.count_if(F.col(spec.headline_status) == PUBLISHED).alias("start_rows_published"),
            withheld.alias("start_rows_suppressed"),
            safe_divide(withheld, F.count("*")).alias("suppression_rate"),
            safe_divide(F.sum(spec.outcome), F.sum(spec.headline)).alias("achievement_ratio"),
        )
    )


def level_shift(fact: DataFrame, spec: TableSpec) -> DataFrame:
    """Share of each level in its area and year, and the change since its first year.

    The windows run over the aggregated rows, at most years x areas x levels.
    """
    by_level = (
        detail_current(fact)
        .filter(
            (F.col(spec.level) != spec.unknown_level) & F.col(spec.headline).isNotNull()
        )
        .groupBy(*YEAR, spec.area_level, spec.area_name, spec.level)
        .agg(F.sum(spec.headline).alias("starts"))
    )
    area_year = Window.partitionBy("academic_year_start", spec.area_level, spec.area_name)
    history = (
        Window.partitionBy(spec.area_level, spec.area_name, spec.level)
        .orderBy("academic_year_start")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return (
        by_level.withColumn("area_year_starts", F.sum("starts").over(area_year))
        .withColumn("level_share", safe_divide(F.col("starts"), F.col("area_year_starts")))
        .withColumn(
            "share_change_vs_baseline",
            F.col("level_share") - F.first("level_share").over(history),
        )
    )


def pipeline_health(
    fact: DataFrame,
    silver: DataFrame,
    versions: DataFrame,
    spec: TableSpec,
    as_of: date | str | None = None,
    tolerance: float = 0.001,
    stale_days: int = 120,
    max_suppression: float = 0.35,
) -> DataFrame:
    """Volume, completeness, integrity, reconciliation and freshness per year.

    The year's figures, including both sides of the reconciliation, come from
    one aggregation of the current records. ``as_of`` defaults to today.
    """
    value = F.col(spec.headline)
    status = F.col(spec.headline_status)
    national = F.col(spec.area_level) == spec.national
    detail = national & F.col("is_detail_grain")
    official = national & (F.col("aggregation_depth") == len(spec.dims)) & value.isNotNull()
    per_year = (
        fact.filter("is_current")
        .groupBy(*YEAR)
        .agg(
            F.count("*").alias("fact_rows"),
            F.count_if("is_detail_grain").alias("detail_rows"),
            F.sum(F.when(detail, value).otherwise(0)).alias("national_starts"),
            safe_divide(F.count_if(status != PUBLISHED), F.count("*")).alias("suppression_rate"),
            F.count_if(status == UNRECOGNISED).alias("unrecognised_markers"),
            F.sum(F.when(detail, value)).alias("detail_starts"),
            F.max(F.when(official, value)).alias("_published"),
            F.count_if(detail).alias("_details"),
        )
        .withColumn("published_starts", F.when(F.col("_details") > 0, F.col("_published")))
        .drop("_published", "_details")
    )
    error = safe_divide(
        F.abs(F.col("detail_starts") - F.col("published_starts")), F.col("published_starts")
    )
    order = versions.select(F.col("version").alias("dataset_version"), "version_seq")
    lineage = (
        silver.groupBy("dataset_version")
        .agg(F.max("ingested_date").alias("ingested_date"))
        .join(order, "dataset_version")
        .agg(
            F.struct(
                F.max("ingested_date").alias("last_ingested_date"),
                F.max_by("dataset_version", "version_seq").alias("latest_version_loaded"),
            )
        )
        .scalar()
    )
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return (
        per_year.withColumn("reconciliation_error", error)
        .withColumn("_lineage", lineage)
        .select(
            *per_year.columns,
            "reconciliation_error",
            F.col("_lineage.last_ingested_date").alias("last_ingested_date"),
            F.col("_lineage.latest_version_loaded").alias("latest_version_loaded"),
            F.date_diff(today, F.col("_lineage.last_ingested_date")).alias("days_since_last_load"),
        )
        .withColumn(
            "health_status",
            F.when(F.col("unrecognised_markers") > 0, "critical")
            .when(F.col("reconciliation_error") > tolerance, "critical")
            .when(F.col("days_since_last_load") > stale_days, "warning")
            .when(F.col("suppression_rate") > max_suppression, "warning")
            .otherwise("ok"),
        )
    )


def region_narrative_facts(trends: DataFrame, spec: TableSpec) -> DataFrame:
    """Two years of sums and the withheld and published cells of each region."""
    first, last = spec.narrative_years
    year = F.col("academic_year_start")
    return (
        trends.filter(F.col(spec.area_name) != spec.residual_area)
        .groupBy(spec.area_name)
        .agg(
            F.sum(F.when(year == last, F.col("starts"))).alias("starts_last"),
            F.sum(F.when(year == first, F.col("starts"))).alias("starts_first"),
            F.sum(F.when(year == last, F.col("achievements"))).alias("achievements_last"),
            F.sum("start_rows_suppressed").alias("suppressed_cells"),
            F.sum("start_rows_published").alias("published_cells"),
        )
    )


def _shown(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("WITHHELD"))


def region_prompts(facts: DataFrame, spec: TableSpec, subject: str = "starts") -> DataFrame:
    """A brief per region that can be handed to a text generator without disclosure risk.

    Withheld sums read ``WITHHELD``; the number of withheld cells goes along.
    """
    first, last = (F.lit(f"{y}/{(y + 1) % 100:02d}") for y in spec.narrative_years)
    region = F.col(spec.area_name)
    cells = F.col("suppressed_cells") + F.col("published_cells")
    prompt = F.concat(
        F.lit(f"Summarise {subject} in "), region, F.lit(" in two sentences.\n"),
        F.lit("Published figures, each rounded to the nearest 10:\n"),
        first, F.lit(" starts: "), _shown("starts_first"), F.lit("\n"),
        last, F.lit(" starts: "), _shown("starts_last"), F.lit("\n"),
        last, F.lit(" achievements: "), _shown("achievements_last"), F.lit("\n"),
        F.lit("cells withheld for disclosure control: "),
        F.col("suppressed_cells").cast("string"), F.lit(" of "), cells.cast("string"), F.lit("\n"),
        F.lit("Say that a WITHHELD figure is not published; do not estimate it. "),
        F.lit("Mention incomplete totals when many cells are withheld. "),
        F.lit("Treat every figure as history, not as a forecast. "),
        F.lit("Call the region "), region, F.lit("."),
    )
    return facts.select(spec.area_name, "suppressed_cells", prompt.alias("prompt"))


def mix_features(fact: DataFrame, spec: TableSpec) -> DataFrame:
    """Share of each named level per region over its final years."""
    starts = F.col(spec.headline)
    totals = (
        detail_current(fact, (spec.area_level, spec.regional))
        .filter((F.col(spec.area_name) != spec.residual_area) & ~F.col("is_provisional"))
        .filter(starts.isNotNull())
        .groupBy(spec.area_name)
        .agg(
            F.sum(starts).alias("_total"),
            *[
                F.sum(F.when(F.col(spec.level) == member, starts).otherwise(0)).alias(name)
                for name, member in spec.mix_levels.items()
            ],
        )
    )
    return totals.select(
        spec.area_name,
        *[safe_divide(F.col(n), F.col("_total")).alias(n) for n in spec.mix_levels],
    )


def restatement_features(
    history: DataFrame, measure: str, key: Sequence[str] = ("row_key",)
) -> DataFrame:
    """Shape of every revision that has a delta: size, relative size, disclosure, base.

    ``key`` and the two versions say which revision it is.
    """
    delta = F.col(f"{measure}_delta")
    return history.filter(delta.isNotNull()).select(
        *key,
        "restated_from_version",
        "restated_in_version",
        F.abs(delta).alias("abs_delta"),
        F.abs(F.coalesce(F.col(f"{measure}_pct_change"), F.lit(0.0))).alias("abs_pct_change"),
        F.when(F.col("disclosure_status_changed"), 1).otherwise(0).alias("disclosure_changed"),
        F.coalesce(F.col(f"{measure}_before"), F.lit(0)).alias("size_before"),
    )


def share_series(
    fact: DataFrame, spec: TableSpec, levels: Sequence[str], provisional: bool = False
) -> DataFrame:
    """Yearly national share of each level, dated 1 September of the year.

    Final years only, or with ``provisional`` only the part years.
    """
    starts = F.col(spec.headline)
    rows = detail_current(fact, (spec.area_level, spec.national)).filter(
        F.col(spec.level) != spec.unknown_level
    )
    held = F.col("is_provisional") if provisional else ~F.col("is_provisional")
    totals = (
        rows.filter(held)
        .groupBy("academic_year_start")
        .agg(
            F.sum(starts).alias("_total"),
            *[
                F.sum(F.when(F.col(spec.level) == member, starts).otherwise(0)).alias(f"s{i}")
                for i, member in enumerate(levels)
            ],
        )
    )
    rows = [c for i, member in enumerate(levels) for c in (F.lit(member), F.col(f"s{i}"))]
    return totals.select(
        "academic_year_start",
        "_total",
        F.stack(F.lit(len(levels)), *rows).alias("level", "_starts"),
    ).select(
        "level",
        "academic_year_start",
        F.make_date(F.col("academic_year_start").cast("int"), F.lit(9), F.lit(1)).alias("yr"),
        safe_divide(F.col("_starts"), F.col("_total")).alias("share"),
    )


def feed_national_trend(fact: DataFrame, spec: TableSpec) -> DataFrame:
    """Starts and achievements per year."""
    return (
        detail_current(fact, (spec.area_level, spec.national))
        .groupBy(*YEAR)
        .agg(
            F.sum(spec.headline).alias("starts"),
            F.sum(spec.outcome).alias("achievements"),
        )
    )


def feed_level_mix(trends: DataFrame, spec: TableSpec, levels: Sequence[str]) -> DataFrame:
    """Regional total over the full years and each level's percentage, one decimal."""
    starts = F.col("starts")
    totals = (
        trends.filter((F.col(spec.area_name) != spec.residual_area) & ~F.col("is_provisional"))
        .groupBy(spec.area_name)
        .agg(
            F.sum(starts).alias("total"),
            *[
                F.coalesce(F.sum(F.when(F.col(spec.level) == v, starts)), F.lit(0)).alias(f"s{i}")
                for i, v in enumerate(levels)
            ],
        )
    )
    return totals.select(
        spec.area_name,
        "total",
        *[
            (per_mille(F.col(f"s{i}"), F.col("total")) / 10).alias(f"pct_{re.sub('[^a-z0-9]+', '_', v.lower())}")
            for i, v in enumerate(levels)
        ],
    )


def feed_suppression(trends: DataFrame, spec: TableSpec) -> DataFrame:
    """Withheld cells over all cells per region, as a percentage with one decimal."""
    cells = (
        trends.filter(F.col(spec.area_name) != spec.residual_area)
        .groupBy(spec.area_name)
        .agg(
            F.sum("start_rows_suppressed").alias("suppressed"),
            F.sum(F.col("start_rows_suppressed") + F.col("start_rows_published")).alias("total"),
        )
    )
    rate = per_mille(F.col("suppressed"), F.col("total")) / 10
    return cells.select(spec.area_name, rate.alias("rate"), "suppressed", "total")


def feed_revisions(history: DataFrame) -> DataFrame:
    """Figures revised and disclosure changes per pair of versions."""
    pair = F.concat("restated_from_version", F.lit(" to "), "restated_in_version")
    return (
        history.groupBy("restated_from_version", "restated_in_version")
        .agg(
            F.count("*").alias("revised"),
            F.count_if("disclosure_status_changed").alias("disclosure"),
        )
        .select(pair.alias("revision"), "revised", "disclosure")
    )
