"""Histories kept as base and change sets against full builds, in any order of arrival."""

import random

import pytest
from pyspark.sql import functions as F
from test_history import NAMES, SCHEMA, random_rows, release

from statledger.operators.history import scd2
from statledger.plans import ledger as module
from statledger.plans.ledger import Ledger
from statledger.session import scratch_path, written
from statledger.sources.commits import ConcurrentLoad, add_entry, list_names, read_entry

KEPT = (["key"], "version_seq", ["value", "value_status"], ["name"])


def fresh(spark, **options):
    return Ledger(spark, scratch_path(spark, "ledger-test"), *KEPT, **({"buckets": 2} | options))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def listed(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def rebuilt(spark, rows, **options):
    return scd2(frame(spark, rows), *KEPT, **options)


def of(rows, *seqs):
    return [r for r in rows if r[1] in seqs]


@pytest.mark.parametrize(("seed", "break_on_gap"), [(1, False), (4, True)])
def test_any_order_of_arrival_equals_a_full_build(spark, seed, break_on_gap):
    rows = random_rows(seed, keys=40)
    order = list(NAMES)[:5]
    random.Random(seed).shuffle(order)
    kept = fresh(spark, break_on_gap=break_on_gap)
    for count, seq in enumerate(order, 1):  # five loads
        kept.load(frame(spark, of(rows, seq)))
        if count in (3, 5):
            whole = rebuilt(spark, of(rows, *order[:count]), break_on_gap=break_on_gap)
            assert listed(kept.records()) == listed(whole)
    assert listed(kept.last_records()) == listed(kept.records().where("NOT is_superseded").drop(
        "is_current", "is_soft_deleted", "is_superseded"))


@pytest.mark.parametrize("seq", [3, 6])
def test_a_version_extracted_again_is_spliced(spark, seq):
    rows = random_rows(7, keys=40)
    kept = fresh(spark)
    kept.load(frame(spark, rows))
    rng = random.Random(seq)
    again = [release(r[0], seq, rng.choice([10, 20, None]), "later") for r in of(rows, seq)[::3]]
    again.append(release("unseen", seq, 5))
    kept.load(frame(spark, again))
    replaced = {r[0] for r in again}
    merged = [r for r in rows if r[1] != seq or r[0] not in replaced] + again
    assert listed(kept.records()) == listed(rebuilt(spark, merged))
    assert [s["kind"] for s in kept.state()["sets"]][-1] in ("splice", "base")


def test_an_older_extraction_that_arrives_later_changes_nothing(spark):
    def dated(rows, day):
        return frame(spark, rows).withColumn("day", F.lit(day).cast("date"))

    kept = fresh(spark, extracted="day")
    kept.load(dated([release("a", 1, 5), release("a", 2, 6)], "2025-03-02"))
    kept.load(dated([release("a", 1, 9), release("b", 1, 1)], "2025-03-01"))
    expected = [release("a", 1, 5), release("a", 2, 6), release("b", 1, 1)]
    assert listed(kept.records()) == listed(rebuilt(spark, expected))


def test_only_changes_are_written(spark):
    rows = [release(f"k{k}", s, 5) for k in range(1000) for s in (1, 2, 3)]
    rows[1] = release("k0", 2, 6)
    kept = fresh(spark)
    for seq in (1, 2, 3):
        kept.load(frame(spark, of(rows, seq)))
    sizes = {(r["set_no"], r["sort"]): r["records"] for r in kept.changed_records().collect()}
    assert sizes == {(0, "last"): 1000, (1, "last"): 1, (1, "closed"): 1, (2, "last"): 1, (2, "closed"): 1}
    assert kept.records().where("is_current").count() == 1000
    kept.load(frame(spark, [release("k7", 2, 8)]))
    assert [s["kind"] for s in kept.state()["sets"]] == ["base", "advance", "advance", "splice"]
    newest = kept.changed_records().where("set_no = 3").collect()
    assert {(r["sort"], r["records"]) for r in newest} == {("last", 1), ("closed", 2)}
    rows[7 * 3 + 1] = release("k7", 2, 8)
    assert listed(kept.records()) == listed(rebuilt(spark, rows))


def test_merging_keeps_the_records(spark, monkeypatch):
    monkeypatch.setattr(module, "MERGE_SHARE", 1e9)
    rows = random_rows(4, keys=50)
    kept = fresh(spark)
    for seq in (1, 3, 2, 4):
        kept.load(frame(spark, of(rows, seq)))
    before = listed(kept.records())
    assert len(kept.state()["sets"]) == 4
    assert [s["kind"] for s in kept.merge()["sets"]] == ["base"]
    assert listed(kept.records()) == before
    monkeypatch.setattr(module, "MERGE_SHARE", 0.0)
    kept.load(frame(spark, of(rows, 5, 6)))
    assert len(kept.state()["sets"]) == 1
    assert listed(kept.records()) == listed(rebuilt(spark, rows))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_shuffle_of_what_is_stored(spark, monkeypatch):
    """Records are read, a version is compared and a late one spliced without dealing anything stored again."""
    monkeypatch.setattr(module, "MERGE_SHARE", 1e9)
    rows = random_rows(5, keys=30)
    kept = fresh(spark, buckets=9)
    for seq in (1, 3, 2, 5, 4):
        kept.load(frame(spark, of(rows, seq)))
    assert [s["kind"] for s in kept.state()["sets"]].count("splice") == 2
    for df in (kept.last_records(), kept.records()):
        assert "Exchange hashpartitioning" not in plan(df) and "Bucketed: true" in plan(df)
    seen = []
    monkeypatch.setattr(module, "add_bucketed", lambda df, *args: seen.append(plan(df)))
    monkeypatch.setattr(module, "written", lambda df, name: (seen.append(plan(df)), written(df, name))[1])
    state = kept.state()
    staged = state | {"rows": state["rows"] | {"3": state["rows"]["1"], "6": state["rows"]["5"]}}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        kept._advance(state, staged, 6, "12.0")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" in seen[0] and "Exchange" not in seen[0]
    kept._splice(state, staged, 3)
    assert len(seen) == 4 and "LeftSemi" in seen[-1]
    compared, differing, touched, spliced = seen
    assert not any("Exchange hashpartitioning" in s for s in (compared, differing, spliced))
    assert "BroadcastHashJoin" in touched  # few keys go to the stored records


def test_two_loads_at_once_both_count(spark, monkeypatch):
    rows = random_rows(6, keys=20)
    one, other = fresh(spark), None
    other = Ledger(spark, one.root, *KEPT, buckets=3)
    one.load(frame(spark, of(rows, 1)))
    publish, overtaken = Ledger._publish, []

    def late(self, state, after):
        if self is one and not overtaken:
            overtaken.append(True)
            other.load(frame(spark, of(rows, 3)))
        return publish(self, state, after)

    monkeypatch.setattr(Ledger, "_publish", late)
    one.load(frame(spark, of(rows, 2)))
    assert overtaken and listed(one.records()) == listed(rebuilt(spark, of(rows, 1, 2, 3)))


def test_a_load_overtaken_always_gives_up(spark, monkeypatch):
    kept = fresh(spark)
    kept.load(frame(spark, [release("a", 1, 1)]))
    before = listed(kept.records())
    monkeypatch.setattr(module, "add_entry", lambda *args: False)
    with pytest.raises(ConcurrentLoad):
        kept.load(frame(spark, [release("a", 2, 2)]))
    assert listed(kept.records()) == before


def test_failed_check_publishes_nothing(spark):
    kept = fresh(spark)

    def refuse(records):
        raise ValueError(records.count())

    with pytest.raises(ValueError, match="1"):
        kept.load(frame(spark, [release("a", 1, 1)]), check=refuse)
    with pytest.raises(FileNotFoundError):
        kept.records()


def test_labels_and_empty_loads(spark):
    kept = fresh(spark)
    assert kept.load(frame(spark, [])) is None and not kept.is_loaded("x")
    kept.load(frame(spark, [release("a", 1, 1)]), "x")
    assert kept.is_loaded("x") and not kept.is_loaded("y")
    kept.load(frame(spark, []), "y")
    assert kept.is_loaded("y") and kept.records().count() == 1


def test_another_session_reads_the_buckets(spark):
    kept = fresh(spark)
    kept.load(frame(spark, random_rows(1, keys=9)))
    expected = listed(kept.records())
    for t in spark.catalog.listTables():
        if t.name.startswith("by_key_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert listed(Ledger(spark, kept.root, *KEPT).records()) == expected


def test_an_entry_is_added_once(spark, tmp_path):
    folder = str(tmp_path / "log")
    assert list_names(spark, folder) == []
    assert add_entry(spark, folder, "0.json", {"a": 1})
    assert not add_entry(spark, folder, "0.json", {"a": 2})
    assert read_entry(spark, folder, "0.json") == {"a": 1}
    assert list_names(spark, f"{folder}/_aside") == []
