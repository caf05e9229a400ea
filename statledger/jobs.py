"""Command-line jobs for ``spark-submit`` or ``python -m statledger.jobs``.

    list-versions --pages DIR
    land          --source CSV --landing DIR --version X [--metadata JSON]
    backfill      --releases DIR --landing DIR --versions CSV
    watch         --releases DIR --landing DIR --versions CSV --state DIR
    build         --landing DIR --root DIR --versions CSV
    load          --landing DIR --root DIR --versions CSV --checkpoint DIR
    check         --root DIR --landing DIR --versions CSV
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from importlib import import_module

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from statledger.operators.quality import QualityGateError, fact_report, gate, silver_report
from statledger.plans.warehouse import Warehouse
from statledger.sources.bronze import (
    land_files,
    read_manifest,
    record_load,
    store_metadata,
    utc_today,
)
from statledger.sources.catalogue import (
    read_metadata,
    read_versions,
    version_history,
    version_listing,
    version_pages,
)
from statledger.spec import TableSpec
from statledger.streaming.incremental import (
    extend_or_rebuild,
    load_if_new,
    rebuild,
    run_incremental,
)


def _spec(name: str) -> TableSpec:
    module, _, attribute = name.partition(":")
    return getattr(import_module(module), attribute)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="statledger.jobs", description=__doc__)
    parser.add_argument("--spec", type=_spec, default="statledger.spec:EDUCATION_HEADLINE")
    jobs = parser.add_subparsers(dest="job", required=True)

    listing = jobs.add_parser("list-versions", help="list the landed version pages")
    listing.add_argument("--pages", required=True)

    landing = jobs.add_parser("land", help="add downloaded files to the landing layer")
    landing.add_argument("--source", required=True)
    landing.add_argument("--version", required=True)
    landing.add_argument("--ingest-date", help="default: today in UTC")
    landing.add_argument("--landing", required=True)
    landing.add_argument("--metadata", help="the release's metadata document")

    for name, text in (
        ("backfill", "land every listed version that is not landed yet"),
        ("watch", "land the newest listed version unless it was landed last"),
    ):
        job = jobs.add_parser(name, help=text)
        job.add_argument("--releases", required=True, help="holds <version>.csv, <version>.json")
        for option in ("--landing", "--versions"):
            job.add_argument(option, required=True)
        if name == "watch":
            job.add_argument("--state", required=True)

    for name, text in (
        ("build", "rebuild all tables from the landing layer"),
        ("load", "load what landed since the last run"),
        ("check", "print every check of the published tables"),
    ):
        job = jobs.add_parser(name, help=text)
        for option in ("--landing", "--root", "--versions"):
            job.add_argument(option, required=True)
        if name == "load":
            job.add_argument("--checkpoint", required=True)
            job.add_argument("--full", action="store_true", help="always rebuild")
    for job in jobs.choices.values():
        job.add_argument("--plain", action="store_true", help="no cell holds a line break")
    return parser.parse_args(argv)


def _land(spark: SparkSession, args, version: str, source: str, metadata: str | None, day=None):
    """One release into the landing layer, with its metadata and its manifest record."""
    columns, day = args.spec.bronze_columns, day or utc_today()
    land_files(spark, source, args.landing, columns, version, day, not args.plain)
    if metadata:
        store_metadata(read_metadata(spark, metadata), args.landing, version, day)
    record_load(spark, args.landing, columns, version, day).show(truncate=False)


def _land_release(spark: SparkSession, args, version: str) -> None:
    metadata = f"{args.releases}/{version}.json"
    try:
        read_metadata(spark, metadata)
    except AnalysisException:
        metadata = None
    _land(spark, args, version, f"{args.releases}/{version}.csv", metadata)


def _landed_versions(spark: SparkSession, landing: str) -> set[str]:
    try:
        return {r["dataset_version"] for r in read_manifest(spark, landing).collect()}
    except AnalysisException:
        return set()


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _arguments(argv)
    spark = spark or SparkSession.builder.appName(f"statledger-{args.job}").getOrCreate()
    spec = args.spec
    if args.job == "list-versions":
        version_listing(version_history(version_pages(spark, args.pages))).show(truncate=False)
        return 0
    if args.job == "land":
        _land(spark, args, args.version, args.source, args.metadata, args.ingest_date)
        return 0

    versions = read_versions(spark, args.versions)
    if args.job == "backfill":
        landed = _landed_versions(spark, args.landing)
        for row in versions.orderBy("version_seq").collect():  # one per release
            if row["version"] not in landed:
                _land_release(spark, args, row["version"])
        return 0
    if args.job == "watch":
        print(load_if_new(versions, args.state, lambda v: _land_release(spark, args, v)))
        return 0

    warehouse = Warehouse(
        spark, args.root, args.landing, versions, spec, quoted_newlines=not args.plain
    )
    if args.job == "build":
        warehouse.build()
    elif args.job == "load":
        publish = (rebuild if args.full else extend_or_rebuild)(warehouse)
        run_incremental(
            spark,
            args.landing,
            args.checkpoint,
            spec.bronze_columns,
            publish,
            quoted_newlines=not args.plain,
        )
    else:
        report = silver_report(warehouse.silver(), versions, spec).unionByName(
            fact_report(warehouse.fact(), versions, spec)
        )
        report.show(200, truncate=False)
        try:
            gate(report)
        except QualityGateError as failed:
            print(failed)
            return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
