"""A type-2 history kept as a base and change sets, all bucketed by key.

Every load writes the rows of its versions and the records they change, nothing else: records that reach the newest version
have no stored end, so a version that repeats them leaves them alone. A version newer than all before is compared with the
last records; one that arrives late, or again, is spliced into the history of the keys it touches, from their stored rows.
Joins and windows find all sides dealt by key alike, so only what arrives is shuffled.

``state`` is the newest entry of a log that one writer at a time can extend. A failed or overtaken load leaves files that
no entry names. ``merge`` writes a new base when the change sets have grown beside it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.operators.changes import (
    ENDS,
    advance_changes,
    differing_keys,
    record_columns,
    touched_keys,
)
from statledger.operators.history import scd2
from statledger.session import written
from statledger.sources.commits import (
    ConcurrentLoad,
    add_bucketed,
    add_entry,
    list_names,
    read_bucketed,
    read_entry,
)

BASE, ADVANCE, SPLICE = "base", "advance", "splice"
# Columns of stored records besides those of the history.
STORED = ("set_id", "set_no", "splice_no")
LAST, CLOSED = "last", "closed"
# A new base is written once change sets hold this share of its records, or at this many sets.
MERGE_SHARE = 0.5
MERGE_SETS = 16
ATTEMPTS = 5

Check = Callable[[DataFrame], None]


@dataclass
class Ledger:
    """The history of one table below ``root``.

    ``key`` columns are never NULL, and a version has at most one row per key. Where ``extracted`` names a column, a key's row
    of a version is the one extracted last, whatever arrived last; otherwise a later arrival replaces it.
    """

    spark: SparkSession
    root: str
    key: Sequence[str]
    seq: str
    compare: Sequence[str]
    carry: Sequence[str] = ()
    version: str = "dataset_version"
    published: str = "published_at"
    extracted: str | None = None
    buckets: int | None = None
    break_on_gap: bool = False

    # -- state -----------------------------------------------------------------------

    @property
    def _log(self) -> str:
        return f"{self.root}/log"

    def _names(self) -> list[str]:
        return [n for n in list_names(self.spark, self._log) if n.endswith(".json")]

    def state(self) -> dict | None:
        """The newest published entry."""
        names = self._names()
        return read_entry(self.spark, self._log, names[-1]) if names else None

    def is_loaded(self, label: str) -> bool:
        """Whether a load with this label was published."""
        names = self._names()
        if not names:
            return False
        log = self.spark.read.schema("label string").json([f"{self._log}/{n}" for n in names])
        return not log.where(F.col("label") == label).isEmpty()

    def _publish(self, state: dict, after: dict | None) -> dict:
        number = after["number"] + 1 if after else 0
        state = state | {"number": number}
        if not add_entry(self.spark, self._log, f"{number:012d}.json", state):
            raise ConcurrentLoad(f"another load was published as number {number}")
        return state

    # -- stored tables -----------------------------------------------------------------

    def _read(self, state: dict, folder: str, schema: dict, ids: Sequence[str]) -> DataFrame:
        """Published rows of a folder, one scan whatever the number of loads that added to it."""
        kind = T.StructType.fromJson(schema)
        stored = read_bucketed(self.spark, f"{self.root}/{folder}", kind, self.key, state["buckets"])
        return stored.where(F.col("set_id").isin(list(ids)))

    def _rows(self, state: dict, *seqs: int) -> DataFrame:
        """Rows of some versions, or of all; none of a version that was never loaded."""
        held = state["rows"]
        ids = [held[str(s)] for s in seqs if str(s) in held] if seqs else list(held.values())
        return self._read(state, "rows", state["row_schema"], ids).drop("set_id")

    def _stored(self, state: dict, sort: str) -> DataFrame:
        ids = [held["id"] for held in state["sets"]]
        return self._read(state, f"{state['epoch']}/{sort}", state["record_schema"], ids)

    def _last(self, state: dict) -> DataFrame:
        """The last record of every key: the one in the newest set that has one."""
        newest = Window.partitionBy(*self.key).orderBy(F.desc("set_no"))
        ranked = self._stored(state, LAST).withColumn("_n", F.row_number().over(newest))
        return ranked.where("_n = 1").drop("_n", *STORED)

    def _closed(self, state: dict) -> DataFrame:
        """Superseded records, without those of keys that a later set spliced."""
        closed = self._stored(state, CLOSED)
        if any(held["kind"] == SPLICE for held in state["sets"]):
            spliced = self._stored(state, LAST).where("splice_no > 0").groupBy(*self.key)
            since = spliced.agg(F.max("splice_no").alias("_since"))
            closed = closed.join(since, list(self.key), "left").where("_since IS NULL OR set_no >= _since").drop("_since")
        return closed.drop(*STORED)

    def _valid(self, state: dict) -> DataFrame:
        last = self._last(state).withColumn("is_superseded", F.lit(False))
        return last.unionByName(self._closed(state).withColumn("is_superseded", F.lit(True)))

    def _ended(self, state: dict, records: DataFrame) -> DataFrame:
        """Open records with the newest version as their end."""
        ends = (F.lit(state["newest_seq"]).cast("bigint"), F.lit(state["newest_version"]))
        is_open = F.col("valid_to_seq").isNull()
        return records.withColumns(
            {c: F.when(is_open, e).otherwise(F.col(c)) for c, e in zip(ENDS, ends, strict=True)}
        )

    def _records(self, state: dict) -> DataFrame:
        newest = F.lit(state["newest_seq"])
        return self._ended(state, self._valid(state)).select(
            *self.key,
            *record_columns(self.compare, self.carry),
            (F.col("valid_to_seq") == newest).alias("is_current"),
            (F.col("valid_to_seq") < newest).alias("is_soft_deleted"),
            "is_superseded",
        )

    def records(self) -> DataFrame:
        """All records, with the columns of ``scd2``."""
        return self._records(self._loaded())

    def last_records(self) -> DataFrame:
        """The last record of each key; superseded ones are not read."""
        return self._ended(self._loaded(), self._last(self._loaded()))

    def rows(self) -> DataFrame:
        """The rows the history is made of."""
        return self._rows(self._loaded())

    def _loaded(self) -> dict:
        state = self.state()
        if state is None:
            raise FileNotFoundError(f"nothing was loaded below {self.root}")
        return state

    # -- loads -------------------------------------------------------------------------

    def _add_set(self, state: dict, kind: str, records: DataFrame) -> dict:
        made = uuid.uuid4().hex
        sets, epoch = ([], f"records-{made}") if kind == BASE else (state["sets"], state["epoch"])
        number = len(sets)
        stored = records.withColumns(
            {
                "set_id": F.lit(made),
                "set_no": F.lit(number),
                "splice_no": F.lit(number if kind == SPLICE else 0),
                "_sort": F.when(F.col("is_superseded"), CLOSED).otherwise(LAST),
            }
        ).drop("is_superseded")
        add_bucketed(stored, f"{self.root}/{epoch}", self.key, state["buckets"], "_sort")
        schema = T.StructType([f for f in stored.schema if f.name != "_sort"])
        added = {"sets": [*sets, {"id": made, "kind": kind}], "epoch": epoch, "record_schema": schema.jsonValue()}
        return state | added

    def _stage_rows(self, state: dict, rows: DataFrame, seqs: Sequence[int]) -> dict[str, str]:
        """Store the rows of arriving versions; what was loaded of them before stays where it is not replaced."""
        again = [s for s in seqs if str(s) in state["rows"]]
        if again:
            rank = [F.desc(self.extracted)] if self.extracted else []
            newest = Window.partitionBy(*self.key, self.seq).orderBy(*rank, F.desc("_arrived"))
            held = self._rows(state, *again).withColumn("_arrived", F.lit(0))
            both = rows.withColumn("_arrived", F.lit(1)).unionByName(held)
            rows = both.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "_arrived")
        made = uuid.uuid4().hex
        named = rows.withColumn("set_id", F.concat(F.lit(f"{made}-"), F.col(self.seq).cast("string")))
        add_bucketed(named, f"{self.root}/rows", self.key, state["buckets"])
        return {str(s): f"{made}-{s}" for s in seqs}

    def _base(self, state: dict) -> dict:
        return self._add_set(state, BASE, self._with_open_ends(state, self._history(self._rows(state))))

    def _history(self, rows: DataFrame) -> DataFrame:
        return scd2(
            rows, self.key, self.seq, self.compare, self.carry, self.version, self.published,
            break_on_gap=self.break_on_gap,
        )

    def _with_open_ends(self, state: dict, records: DataFrame) -> DataFrame:
        is_open = ~F.col("is_superseded") & (F.col("valid_to_seq") == state["newest_seq"])
        return records.withColumns({c: F.when(~is_open, F.col(c)) for c in ENDS}).select(
            *self.key, *record_columns(self.compare, self.carry), "is_superseded"
        )

    def _advance(self, state: dict, staged: dict, seq: int, label: str) -> dict:
        changes = advance_changes(
            self._last(state), self._rows(staged, seq), self.key, self.seq, self.compare, self.carry,
            (state["newest_seq"], state["newest_version"]), self.version, self.published, self.break_on_gap,
        )
        moved = state | {"newest_seq": seq, "newest_version": label, "rows": state["rows"] | {str(seq): staged["rows"][str(seq)]}}
        return self._add_set(moved, ADVANCE, changes)

    def _splice(self, state: dict, staged: dict, seq: int) -> dict:
        moved = state | {"rows": state["rows"] | {str(seq): staged["rows"][str(seq)]}}
        # Both are stored, so that Spark knows their size and sends few keys to the stored sides.
        differ = written(
            differing_keys(self._rows(state, seq), self._rows(staged, seq), self.key, self.compare, self.carry, self.published),
            "ledger-differing",
        )
        records = self._ended(state, self._valid(state))
        touched = written(touched_keys(differ, records, seq, self.key, self.compare), "ledger-touched")
        made = self._history(self._rows(moved).join(touched, list(self.key), "left_semi"))
        return self._add_set(moved, SPLICE, self._with_open_ends(state, made))

    def _loaded_from(self, before: dict | None, rows: DataFrame, label: str) -> dict:
        arrived = rows.select(self.seq, self.version).distinct().orderBy(self.seq).collect()  # one per version
        seqs = [r[0] for r in arrived]
        buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        state = before or {"buckets": buckets, "rows": {}, "sets": [], "newest_seq": None, "newest_version": None}
        schema = T.StructType([*rows.schema.fields, T.StructField("set_id", T.StringType())])
        state = state | {"label": label, "same_as": None, "row_schema": schema.jsonValue()}
        if not arrived:
            return state if before else None
        staged = state | {"rows": state["rows"] | self._stage_rows(state, rows, seqs)}
        if before is None:
            return self._base(staged | {"newest_seq": seqs[-1], "newest_version": arrived[-1][1]})
        for seq, name in arrived:
            if seq > state["newest_seq"]:
                state = self._advance(state, staged, seq, name)
            else:
                state = self._splice(state, staged, seq)
        return state

    def load(self, rows: DataFrame, label: str = "", check: Check | None = None) -> dict | None:
        """Publish the history with the versions in ``rows``; returns the new state.

        ``check`` gets all records as they would be published and raises if they must not be. If another load was
        published in between, this one starts again from there. The first load without rows publishes nothing.
        """
        rows = written(rows, "ledger-arrived")
        for _ in range(ATTEMPTS):
            before = self.state()
            state = self._loaded_from(before, rows, label)
            if state is None:
                return None
            if check:
                check(self._records(state))
            try:
                published = self._publish(state, before)
            except ConcurrentLoad:
                continue
            return self.merge() if self._is_grown(published) else published
        raise ConcurrentLoad(f"overtaken by other loads {ATTEMPTS} times")

    # -- merging -----------------------------------------------------------------------

    def changed_records(self) -> DataFrame:
        """How many records each set holds, of either sort."""
        return self._sizes(self._loaded())

    def _sizes(self, state: dict) -> DataFrame:
        kinds = F.array(*[F.lit(held["kind"]) for held in state["sets"]])
        parts = [
            self._stored(state, sort)
            .groupBy("set_no")
            .agg(F.count("*").alias("records"))
            .select("set_no", kinds[F.col("set_no")].alias("kind"), F.lit(sort).alias("sort"), "records")
            for sort in (LAST, CLOSED)
        ]
        return reduce(DataFrame.unionByName, parts)

    def _is_grown(self, state: dict) -> bool:
        if len(state["sets"]) < 2:
            return False
        if len(state["sets"]) > MERGE_SETS:
            return True
        base, changed = (F.sum(F.when(F.col("kind") == BASE, F.col("records")).otherwise(0)), F.sum("records"))
        return self._sizes(state).agg(changed - base > MERGE_SHARE * base).first()[0]

    def merge(self) -> dict:
        """Write all records as a new base and publish it; without effect if another load comes first."""
        before = self._loaded()
        state = self._add_set(before, BASE, self._with_open_ends(before, self._records(before)))
        try:
            return self._publish(state | {"label": "", "same_as": before["number"]}, before)
        except ConcurrentLoad:
            return self._loaded()


def keep_ledger(ledger: Ledger, to_rows: Callable[[DataFrame], DataFrame], check: Check | None = None):
    """A ``publish`` function for file-triggered loads: types a batch and loads it, whatever versions it holds."""

    def publish(batch: DataFrame, label: str) -> None:
        if not ledger.is_loaded(label):
            ledger.load(to_rows(batch), label, check)

    return publish
