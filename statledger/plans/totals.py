"""Totals over a ledger's current records, moved by what each load changed.

A group's state holds, per measure, the sum of published values, how many values are published and how many withheld, and
the number of records. All are sums of whole numbers, so a record that goes is taken off exactly and the order of loads
does not matter. Shown totals are NULL where every value of a group is withheld, never 0; a group without records is gone.

``refresh`` compares the stored state with the ledger's: if the ledger only gained change sets, the keys in them are
read with their record before and after, which needs no shuffle but that of the groups; otherwise all last records are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.functions import safe_divide
from statledger.plans.ledger import LAST, STORED, Ledger
from statledger.session import stored_bytes
from statledger.sources.commits import add_entry, list_names, read_entry
from statledger.spec import PUBLISHED

ROWS = "record_count"


def state_columns(measures: Sequence[str]) -> list[str]:
    return [ROWS, *[f"{m}_{part}" for m in measures for part in ("sum", "published", "withheld")]]


def _contributions(measures: Sequence[str], sign: Column) -> list[Column]:
    sums = [F.sum(sign).cast("bigint").alias(ROWS)]
    for m in measures:
        published = F.col(f"{m}_status") == PUBLISHED
        counted = F.when(published, sign).otherwise(0)
        sums += [
            F.sum(F.when(published, sign * F.coalesce(m, F.lit(0))).otherwise(0)).cast("bigint").alias(f"{m}_sum"),
            F.sum(counted).cast("bigint").alias(f"{m}_published"),
            F.sum(sign - counted).cast("bigint").alias(f"{m}_withheld"),
        ]
    return sums


def group_state(records: DataFrame, group: Sequence[str], measures: Sequence[str], sign: Column | None = None) -> DataFrame:
    """State of each group, each record counted ``sign`` times; whole-number measures with their statuses."""
    counted = F.lit(1).cast("bigint") if sign is None else sign
    return records.groupBy(*group).agg(*_contributions(measures, counted))


def merged_state(states: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """States of the same groups added up, without groups that have no record left."""
    added = states.groupBy(*group).agg(*[F.sum(c).alias(c) for c in state_columns(measures)])
    return added.where(F.col(ROWS) != 0)


def shown_totals(state: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Totals as reports show them: NULL where nothing is published, with the share withheld."""
    shown = [F.col(c) for c in (*group, ROWS)]
    for m in measures:
        some = F.col(f"{m}_published") > 0
        shown += [
            F.when(some, F.col(f"{m}_sum")).alias(f"total_{m}"),
            F.col(f"{m}_withheld"),
            safe_divide(F.col(f"{m}_withheld"), F.col(ROWS)).alias(f"{m}_withheld_share"),
        ]
    return state.select(*shown)


def signed_changes(ledger: Ledger, state: dict, known_sets: int) -> DataFrame:
    """Open records that the sets after the first ``known_sets`` took away (-1) or brought (+1).

    One window over the stored records by key finds each touched key's record before and after.
    """
    by_key = Window.partitionBy(*ledger.key)
    known = F.max(F.when(F.col("set_no") < known_sets, F.col("set_no"))).over(by_key)
    stored = ledger._stored(state, LAST).withColumns({"_known": known, "_newest": F.max("set_no").over(by_key)})
    sign = F.when(F.col("set_no") == F.col("_newest"), 1).when(F.col("set_no") == F.col("_known"), -1).cast("bigint")
    touched = stored.where(F.col("_newest") >= known_sets).withColumn("sign", sign)
    return touched.where("sign IS NOT NULL AND valid_to_seq IS NULL").drop("_known", "_newest", *STORED)


@dataclass
class RunningTotals:
    """Totals of ``measures`` by ``group`` over the current records of a ledger, stored below ``root``.

    ``derived`` adds columns that groups are made of to the records.
    """

    ledger: Ledger
    root: str
    group: Sequence[str]
    measures: Sequence[str]
    derived: Mapping[str, Column] | None = None

    def _entry(self) -> dict | None:
        names = [n for n in list_names(self.ledger.spark, f"{self.root}/log") if n.endswith(".json")]
        return read_entry(self.ledger.spark, f"{self.root}/log", names[-1]) if names else None

    def _with_groups(self, records: DataFrame) -> DataFrame:
        return records.withColumns(dict(self.derived)) if self.derived else records

    def _recomputed(self) -> DataFrame:
        state = self.ledger.state()
        current = self.ledger._last(state).where("valid_to_seq IS NULL")
        return group_state(self._with_groups(current), self.group, self.measures)

    def _state(self, entry: dict) -> DataFrame:
        return self.ledger.spark.read.parquet(f"{self.root}/state-{entry['number']}")

    def refresh(self) -> str:
        """Bring the totals up to the ledger's newest load; returns what it took."""
        before, state = self._entry(), self.ledger.state()
        if state is None or (before and before["number"] == state["number"]):
            return "nothing"
        grown = before and before["epoch"] == state["epoch"]
        if before and state.get("same_as") == before["number"]:
            made, how = self._state(before), "relabelled"
        elif grown:
            moved = self._with_groups(signed_changes(self.ledger, state, before["sets"]))
            delta = group_state(moved, self.group, self.measures, F.col("sign"))
            made, how = merged_state(self._state(before).unionByName(delta), self.group, self.measures), "moved"
        else:
            made, how = self._recomputed(), "recomputed"
        path = f"{self.root}/state-{state['number']}"
        made.write.mode("overwrite").parquet(path)
        entry = {"number": state["number"], "epoch": state["epoch"], "sets": len(state["sets"]), "bytes": stored_bytes(self.ledger.spark, path)}
        add_entry(self.ledger.spark, f"{self.root}/log", f"{state['number']:012d}.json", entry)
        return how

    def totals(self) -> DataFrame:
        """Shown totals as of the last refresh."""
        entry = self._entry()
        if entry is None:
            raise FileNotFoundError(f"no totals below {self.root}")
        return shown_totals(self._state(entry), self.group, self.measures)
