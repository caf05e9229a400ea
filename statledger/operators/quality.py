"""Data-quality checks: each returns the failing rows, and empty means pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statledger.operators.profile import reconcile
from statledger.spec import PUBLISHED, STATUSES, UNRECOGNISED, TableSpec

# Parts of a column name that suggest personal data.
IDENTIFIER_PATTERN = r"(email|phone|postcode|address|dob|birth|name_first|surname|nino|ni_number|learner|uln|urn)"  # noqa: E501


class QualityGateError(Exception):
    """A check failed, so nothing downstream may be published."""


def not_null(name: str) -> Column:
    """Predicate of rows failing a not-null rule."""
    return F.col(name).isNull()


def not_in(name: str, values: Sequence) -> Column:
    """Predicate of rows with a value outside the accepted ones; NULL passes."""
    return ~F.col(name).isin(*values)


def outside(name: str, low, high) -> Column:
    """Predicate of rows outside an inclusive range; NULL passes."""
    return ~F.col(name).between(low, high)


def valued_but_withheld(measure: str) -> Column:
    """A figure whose status says it is withheld yet has a value."""
    return (F.col(f"{measure}_status") != PUBLISHED) & F.col(measure).isNotNull()


def published_without_value(measure: str) -> Column:
    """A figure called published that did not fit the measure's type."""
    return (F.col(f"{measure}_status") == PUBLISHED) & F.col(measure).isNull()


def unrecognised(measures: Sequence[str]) -> Column:
    """Any measure with a marker the table's vocabulary lacks."""
    return reduce(or_, [F.col(f"{m}_status") == UNRECOGNISED for m in measures])


def check_rows(df: DataFrame, failing: Column) -> DataFrame:
    """Rows for which the ``failing`` predicate holds."""
    return df.filter(failing)


def check_not_null(df: DataFrame, name: str) -> DataFrame:
    return check_rows(df, not_null(name))


def check_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    return check_rows(df, not_in(name, values))


def check_range(df: DataFrame, name: str, low, high) -> DataFrame:
    return check_rows(df, outside(name, low, high))


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count("*").alias("copies")).filter("copies > 1")


def check_relationship(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose value has no parent; NULL values pass."""
    parents = parent.select(F.col(field).alias(column))
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")


def check_current_count(fact: DataFrame, versions: DataFrame) -> DataFrame:
    """Current records against the newest version's declared total, if they differ."""
    expected = versions.agg(F.max_by("total_results", "version_seq")).scalar()
    return (
        fact.agg(F.count_if("is_current").alias("current_records"))
        .select("current_records", expected.alias("expected_records"))
        .filter("current_records != expected_records")
    )


def check_reconciliation(fact: DataFrame, spec: TableSpec, tolerance: float = 0.001) -> DataFrame:
    """Groups whose detail sum misses the published total by more than ``tolerance``."""
    return (
        reconcile(fact, spec, tolerance=tolerance)
        .filter(F.col("rel_error") > tolerance)
        .drop("within_tolerance")
    )


def check_lineage(fact: DataFrame, least: int = 2) -> DataFrame:
    """Number of versions the history still starts records in, if below ``least``."""
    return version_lineage(fact).filter(F.col("versions") < least)


def version_lineage(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_distinct("valid_from_version").alias("versions"))


def database_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """All tables of a catalogue database by name."""
    return {
        t.name: spark.table(t.name if t.isTemporary else f"{database}.{t.name}")
        for t in spark.catalog.listTables(database)
    }


def identifier_columns(
    tables: Mapping[str, DataFrame], pattern: str = IDENTIFIER_PATTERN, whole_words: bool = False
) -> DataFrame:
    """Columns whose name suggests an identifier, with the number of values they hold.

    The pattern may match inside a longer word; with ``whole_words`` it must
    fill the words between underscores that it touches.
    """
    if whole_words:
        pattern = f"(^|_)({pattern})(_|$)"
    spark = next(iter(tables.values())).sparkSession
    catalogue = spark.createDataFrame(
        [(t, c) for t, df in tables.items() for c in df.columns],
        "table_name string, column_name string",
    )
    suspect = catalogue.filter(F.lower("column_name").rlike(pattern))
    # A catalogue is driver metadata; only the flagged columns are scanned.
    flagged: dict[str, list[str]] = {}
    for row in suspect.collect():
        flagged.setdefault(row.table_name, []).append(row.column_name)
    found = [
        tables[t]
        .agg(*[F.count(c).alias(c) for c in cols])
        .select(
            F.lit(t).alias("table_name"),
            F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), F.col(c))]).alias(
                "column_name", "values_held"
            ),
        )
        for t, cols in flagged.items()
    ]
    if not found:
        none = F.lit(0).cast("bigint").alias("values_held")
        return suspect.select("table_name", "column_name", none)
    return reduce(DataFrame.unionByName, found)


def identifier_summary(found: DataFrame) -> DataFrame:
    """The distinct flagged column names in order as one string; NULL when there are none."""
    names = F.sort_array(F.collect_set("column_name"))
    joined = F.when(F.size(names) > 0, F.array_join(names, ","))
    return found.agg(joined.alias("column_names"))


def row_rules(spec: TableSpec) -> dict[str, Column]:
    """The rules every silver row must meet, by name; each predicate selects failures."""
    rules = {f"not_null {c}": not_null(c) for c in ("row_key", "dataset_version")}
    rules |= {f"not_null {c}": not_null(c) for c in ("academic_year_start", "aggregation_depth")}
    rules["range academic_year_start"] = outside("academic_year_start", *spec.year_range)
    depths = range(len(spec.dims) + 1)
    rules["values aggregation_depth"] = not_in("aggregation_depth", list(depths))
    accepted = [s for s in STATUSES if s != UNRECOGNISED]
    for m in spec.measures:
        rules[f"values {m}_status"] = not_in(f"{m}_status", accepted)
        rules[f"withheld with value {m}"] = valued_but_withheld(m)
        rules[f"published without value {m}"] = published_without_value(m)
    return rules


def count_failures(
    df: DataFrame, rules: Mapping[str, Column], totals: Mapping[str, Column] | None = None
) -> DataFrame:
    """Failing rows of every rule, all counted in one pass over ``df``.

    ``rules`` are predicates of failing rows; ``totals`` are aggregates that
    are the number of failures themselves.
    """
    counts = {name: F.count_if(p) for name, p in rules.items()} | dict(totals or {})
    counted = df.agg(*[c.cast("bigint").alias(f"r{i}") for i, c in enumerate(counts.values())])
    rows = [c for i, name in enumerate(counts) for c in (F.lit(name), F.col(f"r{i}"))]
    return counted.select(F.stack(F.lit(len(counts)), *rows).alias("check", "failing_rows"))


def dq_report(checks: Mapping[str, DataFrame], counted: Sequence[DataFrame] = ()) -> DataFrame:
    """One row per check: its name and the number of failing rows.

    ``checks`` maps a name to failing rows; ``counted`` are reports of
    ``count_failures``.
    """
    parts = [
        rows.agg(F.count("*").alias("failing_rows")).select(
            F.lit(name).alias("check"), "failing_rows"
        )
        for name, rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, [*counted, *parts])


def silver_report(silver: DataFrame, versions: DataFrame, spec: TableSpec) -> DataFrame:
    """All checks a silver table must pass before a history is built from it.

    One pass for every row rule, one for uniqueness.
    """
    known = versions.select(
        F.col("version").alias("dataset_version"), F.lit(True).alias("_known")
    ).distinct()
    rules = row_rules(spec)
    rules["relationship dataset_version"] = (
        F.col("dataset_version").isNotNull() & F.col("_known").isNull()
    )
    counted = count_failures(silver.join(known, "dataset_version", "left"), rules)
    unique = check_unique(silver, ["row_key", "dataset_version"])
    return dq_report({"unique row_key, dataset_version": unique}, [counted])


def fact_report(
    fact: DataFrame, versions: DataFrame, spec: TableSpec, tolerance: float = 0.001
) -> DataFrame:
    """All checks a history must pass before it is published.

    One pass for every row rule and total, one for uniqueness, and one over
    the national rows for the reconciliation.
    """
    rules = {f"not_null {c}": not_null(c) for c in ("row_key", "valid_from_seq", "is_current")}
    expected = versions.agg(F.max_by("total_results", "version_seq")).scalar()
    totals = {
        "current records match newest version": F.count_if("is_current") != expected,
        "at least two versions in lineage": F.count_distinct("valid_from_version") < 2,
    }
    return dq_report(
        {
            "unique row_key, valid_from_seq": check_unique(fact, ["row_key", "valid_from_seq"]),
            "detail reconciles to published total": check_reconciliation(fact, spec, tolerance),
        },
        [count_failures(fact, rules, {n: F.when(p, 1).otherwise(0) for n, p in totals.items()})],
    )


def gate(report: DataFrame, allowed: Sequence[str] = ()) -> None:
    """Stop if a check other than the ``allowed`` ones has failing rows."""
    failed = report.filter("failing_rows > 0").filter(~F.col("check").isin(list(allowed)))
    rows = failed.orderBy("check").collect()  # one row per check
    if rows:
        raise QualityGateError(", ".join(f"{r['check']}: {r['failing_rows']}" for r in rows))
