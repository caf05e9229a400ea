"""What the publisher says about its releases: versions, result pages, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS_SCHEMA = (
    "version string, version_type string, published_at date, "
    "total_results bigint, version_seq bigint"
)

VERSION_PAGES_SCHEMA = (
    "results array<struct<version: string, type: string, status: string, published: string, "
    "totalResults: bigint, timePeriods: struct<start: string, end: string>>>, "
    "paging struct<page: int, totalPages: int>"
)

METADATA_SCHEMA = (
    "filters array<struct<id: string, label: string, "
    "options: array<struct<id: string, label: string>>>>, "
    "indicators array<struct<id: string, label: string, unit: string>>, "
    "locations array<struct<level: string, options: array<struct<code: string, label: string>>>>, "
    "timePeriods array<struct<code: string, period: string, label: string>>"
)

# What to do about the newest version.
EXTRACT = "extract"
SKIP = "skip"


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The version seed: order, publication date and declared total of each release."""
    return spark.read.schema(VERSIONS_SCHEMA).option("header", True).csv(path)


def version_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of the version listing, one JSON document per file."""
    return spark.read.schema(VERSION_PAGES_SCHEMA).option("multiLine", True).json(path)


def version_history(pages: DataFrame) -> DataFrame:
    """One row per listed version; absent fields read as empty text or 0."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"v.{name}"), F.lit(""))

    return pages.select(F.explode("results").alias("v")).select(
        F.col("v.version").alias("version"),
        text("type").alias("type"),
        text("status").alias("status"),
        text("published").alias("published"),
        F.coalesce("v.totalResults", F.lit(0)).alias("total_results"),
        text("timePeriods.start").alias("time_period_start"),
        text("timePeriods.end").alias("time_period_end"),
    )


def version_listing(history: DataFrame) -> DataFrame:
    """Short listing: publication day and period range."""
    return history.select(
        "version",
        "type",
        F.substring("published", 1, 10).alias("published"),
        F.col("total_results").alias("row_count"),
        F.concat("time_period_start", F.lit(".."), "time_period_end").alias("periods"),
    )


class IncompletePages(ValueError):
    """Landed pages do not make up the whole document."""


def page_problems(pages: DataFrame, document: Sequence[str] = ()) -> DataFrame:
    """Pages that are missing, repeated or beyond the declared number, with the copies there are.

    ``document`` names the columns that tell documents apart; without any, all pages are of one. The declared
    number is the greatest that any page of a document states. A page without a number is ``unnumbered``.
    """
    keys = list(document)
    seen = pages.groupBy(*keys, F.col("paging.page").alias("page")).agg(
        F.count("*").alias("copies"), F.max("paging.totalPages").alias("declared")
    )
    totals = seen.groupBy(*keys).agg(F.max("declared").alias("total"))
    # A document has some page, so a missing one is found by its number alone.
    wanted = totals.where("total >= 1").select(
        *keys, F.explode(F.sequence(F.lit(1), F.col("total"))).alias("page"), F.lit(True).alias("wanted")
    )
    problem = (
        F.when(F.col("page").isNull(), "unnumbered")
        .when(F.col("copies").isNull(), "missing")
        .when(F.col("wanted").isNull(), "beyond")
        .when(F.col("copies") > 1, "repeated")
    )
    found = seen.drop("declared").join(wanted, [*keys, "page"], "full_outer").withColumn("problem", problem)
    copies = F.coalesce("copies", F.lit(0).cast("bigint")).alias("copies")
    return found.where(F.col("problem").isNotNull()).select(*keys, "page", "problem", copies)


def complete_pages(pages: DataFrame, document: Sequence[str] = ()) -> DataFrame:
    """The pages themselves, if every document has each of its pages once."""
    problems = page_problems(pages, document).orderBy(*document, "page").limit(5).collect()
    if problems:
        raise IncompletePages("; ".join(f"page {p['page']} {p['problem']}" for p in problems))
    return pages


def result_pages(
    spark: SparkSession, path: str, fields: Sequence[str], one_per_file: bool = False
) -> DataFrame:
    """Landed pages of query results, one JSON document per line or per file."""
    row = ", ".join(f"`{f}`: string" for f in fields)
    schema = f"results array<struct<{row}>>, paging struct<page: int, totalPages: int>"
    return spark.read.schema(schema).option("multiLine", one_per_file).json(path)


def query_rows(
    pages: DataFrame,
    criteria: Column | None = None,
    indicators: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of the landed result pages that meets ``criteria``.

    ``indicators`` lists the columns to keep.
    """
    rows = pages.select(F.explode("results").alias("r")).select("r.*")
    if criteria is not None:
        rows = rows.filter(criteria)
    return rows.select(*indicators) if indicators else rows


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata documents stored beside the loads."""
    return spark.read.schema(METADATA_SCHEMA).option("multiLine", True).json(path)


def metadata_labels(metadata: DataFrame) -> DataFrame:
    """Lookup from identifiers to labels for filters, indicators, locations and periods."""
    group = F.explode("filters").alias("g")
    filters = metadata.select(group).select(
        F.lit("filter").alias("kind"), F.col("g.id").alias("of"), F.explode("g.options").alias("o")
    )
    places = metadata.select(F.explode("locations").alias("g")).select(
        F.lit("location").alias("kind"),
        F.col("g.level").alias("of"),
        F.explode("g.options").alias("o"),
    )
    parts = [
        filters.select("kind", "of", F.col("o.id").alias("id"), F.col("o.label").alias("label")),
        places.select("kind", "of", F.col("o.code").alias("id"), F.col("o.label").alias("label")),
        metadata.select(F.explode("indicators").alias("o")).select(
            F.lit("indicator").alias("kind"),
            F.lit("").alias("of"),
            F.col("o.id").alias("id"),
            F.col("o.label").alias("label"),
        ),
        metadata.select(F.explode("timePeriods").alias("o")).select(
            F.lit("period").alias("kind"),
            F.col("o.code").alias("of"),
            F.col("o.period").alias("id"),
            F.col("o.label").alias("label"),
        ),
    ]
    labels = parts[0]
    for part in parts[1:]:
        labels = labels.unionByName(part)
    return labels.distinct()


def version_decision(latest: Column, previous: Column) -> Column:
    """Extract when the newest version is not the one last seen, else skip."""
    return F.when(latest.eqNullSafe(previous), SKIP).otherwise(EXTRACT)


def decide(versions: DataFrame, last_seen: str | None, dataset_id: str = "") -> DataFrame:
    """The decision record for the newest listed version."""
    newest = versions.agg(F.max_by("version", "version_seq").alias("latest_version"))
    previous = F.lit(last_seen).cast("string")
    return newest.select(
        F.lit(dataset_id).alias("dataset_id"),
        version_decision(F.col("latest_version"), previous).alias("action"),
        "latest_version",
        previous.alias("previous_version"),
        F.current_timestamp().alias("decided_at"),
    )


def seed_rows(spark: SparkSession, rows: Sequence[Mapping]) -> DataFrame:
    """A version seed from literal rows."""
    return spark.createDataFrame(list(rows), VERSIONS_SCHEMA)
