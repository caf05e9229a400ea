"""Description of a published table: which columns play which part.

Every operator takes its column names and vocabulary from a ``TableSpec`` or
from explicit arguments, so the same code serves any release of this shape.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Statuses a measure cell can have.
PUBLISHED = "published"
MISSING = "missing"
UNRECOGNISED = "unrecognised"
STATUSES = (
    "published",
    "suppressed_low",
    "suppressed_confidential",
    "not_applicable",
    "missing",
    "unrecognised",
)

# Disclosure-control markers found in the numeric columns.
MARKERS = {
    "low": "suppressed_low",
    "c": "suppressed_confidential",
    "z": "not_applicable",
}


@dataclass(frozen=True)
class TableSpec:
    """Column roles and vocabulary of one published table."""

    dims: tuple[str, ...]
    level: str
    counts: tuple[str, ...] = ("start_count", "achievement_count", "participation_count")
    percents: tuple[str, ...] = ("starts_percent", "achievements_percent")
    period: str = "time_period"
    period_kind: str = "time_identifier"
    area_level: str = "geographic_level"
    country_code: str = "country_code"
    country_name: str = "country_name"
    area_code: str = "region_code"
    area_name: str = "region_name"
    version: str = "version"
    ingested: str = "ingest_date"
    total: str = "Total"
    national: str = "National"
    regional: str = "Regional"
    null_area: str = "NA"
    markers: Mapping[str, str] = field(default_factory=lambda: dict(MARKERS))
    residual_area: str = ""
    unknown_level: str = "Unknown"
    provisional_years: tuple[int, ...] = ()
    year_range: tuple[int, int] = (1900, 2100)
    mix_levels: Mapping[str, str] = field(default_factory=dict)
    narrative_years: tuple[int, int] = (0, 0)

    @property
    def headline(self) -> str:
        """The count the marts are about."""
        return self.counts[0]

    @property
    def outcome(self) -> str:
        return self.counts[1]

    @property
    def activity(self) -> str:
        return self.counts[2]

    @property
    def headline_status(self) -> str:
        return f"{self.headline}_status"

    @property
    def natural_key(self) -> tuple[str, ...]:
        return (self.period, self.area_level, self.area_code, *self.dims)

    @property
    def measures(self) -> dict[str, str]:
        """Measure name to SQL type, counts first."""
        return {c: "bigint" for c in self.counts} | {c: "double" for c in self.percents}

    @property
    def compared(self) -> tuple[str, ...]:
        """Columns whose change opens a new history record."""
        names = tuple(self.measures)
        return names + tuple(f"{m}_status" for m in names)

    @property
    def carried(self) -> tuple[str, ...]:
        """Descriptive columns a history record keeps."""
        return (
            "academic_year_start",
            "academic_year_label",
            self.area_level,
            self.country_code,
            self.country_name,
            self.area_code,
            self.area_name,
            *self.dims,
            "aggregation_depth",
            "is_detail_grain",
            "is_provisional",
        )

    @property
    def bronze_columns(self) -> tuple[str, ...]:
        """Columns of the landed files, in file order."""
        return (
            self.period,
            self.period_kind,
            self.area_level,
            self.country_code,
            self.country_name,
            self.area_code,
            self.area_name,
            *self.dims,
            *self.measures,
        )


# Column names and members of the full-year headline release.
EDUCATION_HEADLINE = TableSpec(
    dims=(
        "apprenticeship_level",
        "age_youth_adult",
        "age_group",
        "funding_type",
        "provider_type",
    ),
    level="apprenticeship_level",
    residual_area="Outside of England and unknown",
    unknown_level="Unknown",
    provisional_years=(2025,),
    year_range=(2017, 2030),
    mix_levels={
        "share_intermediate": "Intermediate Apprenticeship",
        "share_advanced": "Advanced Apprenticeship",
        "share_higher": "Higher Apprenticeship",
    },
    narrative_years=(2017, 2024),
)
