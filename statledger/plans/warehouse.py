"""Landing layer to silver to history, each step checked before it is published."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from statledger.operators.history import advance_history, scd2
from statledger.operators.quality import fact_report, gate, silver_report
from statledger.operators.silver import to_silver, with_version
from statledger.session import sized_shuffles, written
from statledger.sources.bronze import DATA, read_bronze
from statledger.sources.tables import (
    claim_run,
    publications,
    publish_table,
    read_runs,
    read_table,
    stage_table,
)
from statledger.spec import TableSpec

SILVER = ("silver", "typed_rows")
FACT = ("gold", "version_history")
# A patch may change no figure, and a first load has one version only: this check
# blocks once two major versions are loaded.
LINEAGE = "at least two versions in lineage"
MAJOR = "Major"
KEY = ("row_key",)
SEQ = "version_seq"


def history(silver: DataFrame, versions: DataFrame, spec: TableSpec, **options) -> DataFrame:
    """Type-2 history of a silver table."""
    return scd2(
        with_version(silver, versions),
        KEY,
        SEQ,
        spec.compared,
        spec.carried,
        versions=versions,
        **options,
    )


@dataclass
class Warehouse:
    """The derived tables of one published table, below ``root``.

    ``allowed`` names checks that are reported without stopping publication.
    """

    spark: SparkSession
    root: str
    landing: str
    versions: DataFrame
    spec: TableSpec
    allowed: Sequence[str] = field(default_factory=tuple)
    quoted_newlines: bool = True

    def bronze(self) -> DataFrame:
        return read_bronze(
            self.spark, self.landing, self.spec.bronze_columns, self.quoted_newlines
        )

    def _newest_run(self) -> int | None:
        entries = publications(self.spark, self.root, *FACT)
        return entries[0].run if entries else None

    def silver(self) -> DataFrame:
        """Typed rows, as far as the published history covers them."""
        runs = [e.run for e in publications(self.spark, self.root, *FACT)]
        return read_table(self.spark, self.root, *SILVER, runs=runs)

    def fact(self) -> DataFrame:
        """All records of the history.

        Superseded records never change, so every run only adds some; the last
        record of each key is written anew by every run. Both conditions
        are on partition columns.
        """
        return self._records(publications(self.spark, self.root, *FACT))

    def _records(self, entries: Sequence[Row]) -> DataFrame:
        rows = read_runs(self.spark, self.root, *FACT, entries)
        live = F.col("is_superseded") | (F.col("run") == entries[0].run)
        return rows.filter(live).drop("run")

    def last_records(self) -> DataFrame:
        """The last record of each key, among them all current ones."""
        return self.fact().filter("NOT is_superseded")

    def is_loaded(self, label: str) -> bool:
        """Whether the load with this label was published."""
        return any(e.label == label for e in publications(self.spark, self.root, *FACT))

    def _stage_silver(self, rows: DataFrame, run: int) -> DataFrame:
        stored = stage_table(
            rows,
            self.root,
            *SILVER,
            run,
            partition_by=("academic_year_start",),
            cluster_by=("dataset_version", self.spec.area_code, self.spec.level),
        )
        gate(silver_report(stored, self.versions, self.spec), self.allowed)
        return stored

    def _stage_fact(self, records: DataFrame, versions: DataFrame, run: int) -> DataFrame:
        stored = stage_table(
            records,
            self.root,
            *FACT,
            run,
            partition_by=("is_superseded", "academic_year_start"),
            cluster_by=(self.spec.area_code, self.spec.level, "valid_to_seq"),
        )
        majors = versions.filter(F.col("version_type") == MAJOR).count()
        first = (LINEAGE,) if majors < 2 else ()
        gate(fact_report(stored, versions, self.spec), (*self.allowed, *first))
        return stored

    def _claim(self, after: int) -> int:
        return claim_run(self.spark, self.root, *FACT, after + 1)

    def _publish(
        self, silver: DataFrame, fact: DataFrame, run: int, full: bool, label: str, newest: int, after: int
    ) -> None:
        """Publish both tables of a run. Silver rows count once the history names their run."""
        publish_table(silver, self.root, *SILVER, run, full, label, newest)
        publish_table(fact, self.root, *FACT, run, full, label, newest, after)

    def build(self, label: str = "") -> None:
        """Rebuild everything from the landing layer."""
        newest_run = self._newest_run()
        after = -1 if newest_run is None else newest_run
        run = self._claim(after)
        with sized_shuffles(self.spark, f"{self.landing}/{DATA}"):
            silver = self._stage_silver(to_silver(self.bronze(), self.spec), run)
            loaded = silver.select(F.col("dataset_version").alias("version")).distinct()
            versions = self.versions.join(loaded, "version", "left_semi")
            fact = self._stage_fact(history(silver, versions, self.spec), versions, run)
            newest = versions.agg(F.max(SEQ)).first()[0]
            self._publish(silver, fact, run, True, label, newest, after)

    def extend(self, batch: DataFrame, label: str = "") -> bool:
        """Add newly landed versions, touching only each key's last record.

        Neither old silver rows nor superseded records are read or written.
        Possible only if every version in ``batch`` is newer than all loaded
        before; otherwise nothing happens and the result is False.
        """
        entries = publications(self.spark, self.root, *FACT)
        if not entries:
            return False
        batch = written(batch, "arrived")
        after, loaded = entries[0].run, entries[0].newest_seq
        last = self._records(entries).filter("NOT is_superseded")
        arrived = self.versions.join(batch.select("version"), "version", "left_semi")
        oldest, newest = arrived.agg(F.min(SEQ), F.max(SEQ)).first()
        if loaded is None or oldest is None or oldest <= loaded:
            return False
        run = self._claim(after)
        added = self._stage_silver(to_silver(batch, self.spec), run)
        records = advance_history(
            last,
            with_version(added, self.versions),
            KEY,
            SEQ,
            self.spec.compared,
            self.spec.carried,
        )
        fact = self._stage_fact(records, self.versions.filter(F.col(SEQ) <= newest), run)
        self._publish(added, fact, run, False, label, newest, after)
        return True
