"""Type-2 history on hand-made and random releases."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from statledger.operators.dedupe import latest_extraction
from statledger.operators.history import (
    as_of_version,
    extend_history,
    restatement_history,
    scd2,
    text_and_typed_records,
    version_deltas,
)

SCHEMA = (
    "key string, version_seq bigint, dataset_version string, published_at date, "
    "name string, value bigint, value_status string"
)
NAMES = {1: "1.0", 2: "2.0", 3: "10.0", 4: "10.1", 5: "11.0", 6: "12.0"}


def release(key, seq, value, name="n"):
    status = "published" if value is not None else "suppressed_low"
    return (key, seq, NAMES[seq], date(2025, seq, 1), name, value, status)


def history(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return scd2(df, ["key"], "version_seq", ["value", "value_status"], ["name"], **options)


def intervals(fact, key):
    rows = fact.filter(F.col("key") == key).orderBy("valid_from_seq").collect()
    return [(r.valid_from_seq, r.valid_to_seq, r.value) for r in rows]


@pytest.fixture(scope="module")
def rows():
    return [
        *[release("same", s, 5) for s in (1, 2, 3, 4)],
        *[release("flip", s, v) for s, v in ((1, None), (2, None), (3, 10), (4, 10))],
        *[release("gone", s, 7) for s in (1, 2)],
        *[release("gap", s, 9) for s in (1, 3, 4)],
        *[release("back", s, v) for s, v in ((1, 1), (2, 2), (3, 1), (4, 1))],
        *[release("renamed", s, 3, f"name{s}") for s in (1, 2, 3, 4)],
    ]


def test_records(spark, rows):
    fact = history(spark, rows).cache()
    assert intervals(fact, "same") == [(1, 4, 5)]
    assert intervals(fact, "flip") == [(1, 2, None), (3, 4, 10)]
    assert intervals(fact, "gone") == [(1, 2, 7)]
    assert intervals(fact, "gap") == [(1, 4, 9)]
    assert intervals(fact, "back") == [(1, 1, 1), (2, 2, 2), (3, 4, 1)]
    flags = {
        (r.key, r.valid_from_seq): (r.is_current, r.is_soft_deleted, r.is_superseded)
        for r in fact.collect()
    }
    assert flags["same", 1] == (True, False, False)
    assert flags["gone", 1] == (False, True, False)
    assert flags["back", 1] == (False, True, True)
    groups = [r.validity_group for r in fact.filter("key = 'back'").orderBy("valid_from_seq").collect()]
    assert groups == [1, 2, 3]


def test_versions_are_ordered_by_ordinal_not_text(spark, rows):
    record = history(spark, rows).filter("key = 'same'").first()
    assert (record.valid_from_version, record.valid_to_version) == ("1.0", "10.1")
    assert record.valid_from_published == date(2025, 1, 1)


def test_carried_columns_come_from_newest_version(spark, rows):
    assert history(spark, rows).filter("key = 'renamed'").first().name == "name4"


def test_break_on_gap(spark, rows):
    assert intervals(history(spark, rows, break_on_gap=True), "gap") == [(1, 1, 9), (3, 4, 9)]


def test_newest_version_without_rows_leaves_nothing_current(spark, rows):
    versions = spark.createDataFrame([(5,)], "version_seq bigint")
    fact = history(spark, rows, versions=versions)
    assert fact.filter("is_current").isEmpty()


def test_restatements(spark, rows):
    fact = history(spark, rows)
    told = restatement_history(fact, ["key"], "value").collect()
    by = {(r.key, r.restated_in_version): r for r in told}
    assert set(by) == {("flip", "10.0"), ("back", "2.0"), ("back", "10.0")}
    flip = by["flip", "10.0"]
    assert flip.disclosure_status_changed and flip.value_delta is None
    assert (flip.value_before, flip.value_after) == (None, 10)
    back = by["back", "2.0"]
    assert (back.value_delta, back.value_pct_change) == (1, 1.0)
    assert back.restated_from_version == "1.0"
    keys = fact.select("key").distinct().count()
    assert fact.count() == keys + len(told)


def random_rows(seed, keys=60, versions=6):
    dice = random.Random(seed)
    rows = []
    for k in range(keys):
        for s in range(1, versions + 1):
            if dice.random() < 0.75:
                rows.append(release(f"k{k}", s, dice.choice([None, 10, 10, 20])))
    return rows


def brute_force(rows, break_on_gap):
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        by_key.setdefault(r[0], []).append(r)
    out = []
    for key, versions in by_key.items():
        runs = []
        for r in versions:
            same = runs and runs[-1][-1][5:] == r[5:]
            if same and break_on_gap and r[1] - runs[-1][-1][1] > 1:
                same = False
            if same:
                runs[-1].append(r)
            else:
                runs.append([r])
        out += [(key, g + 1, run[0][1], run[-1][1], run[-1][5]) for g, run in enumerate(runs)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("break_on_gap", [False, True])
def test_random_histories(spark, seed, break_on_gap):
    rows = random_rows(seed)
    fact = history(spark, rows, break_on_gap=break_on_gap)
    got = fact.select("key", "validity_group", "valid_from_seq", "valid_to_seq", "value").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force(rows, break_on_gap)


@pytest.mark.parametrize("split", [1, 3, 5])
@pytest.mark.parametrize("break_on_gap", [False, True])
def test_extended_equals_rebuilt(spark, split, break_on_gap):
    rows = random_rows(7)
    compare, carry = ["value", "value_status"], ["name"]
    df = spark.createDataFrame(rows, SCHEMA)
    old, new = df.filter(F.col("version_seq") <= split), df.filter(F.col("version_seq") > split)
    start = scd2(old, ["key"], "version_seq", compare, carry, break_on_gap=break_on_gap)
    grown = extend_history(
        start, new, ["key"], "version_seq", compare, carry, break_on_gap=break_on_gap
    )
    full = scd2(df, ["key"], "version_seq", compare, carry, break_on_gap=break_on_gap)
    assert grown.columns == full.columns
    assert sorted(map(str, grown.collect())) == sorted(map(str, full.collect()))


def test_as_of_equals_release(spark):
    rows = random_rows(11)
    fact = history(spark, rows, break_on_gap=True).cache()
    for seq in range(1, 7):
        got = as_of_version(fact, seq).select("key", "value").collect()
        want = [(r[0], r[5]) for r in rows if r[1] == seq]
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_deltas_against_brute_force(spark):
    rows = random_rows(13)
    df = spark.createDataFrame(rows, SCHEMA)
    versions = spark.createDataFrame(
        [(s, n, "Major") for s, n in NAMES.items()],
        "version_seq bigint, version string, version_type string",
    )
    got = version_deltas(
        df, ["key"], "version_seq", {"restated": ["value", "value_status"]}, versions
    ).collect()
    held = {s: {r[0]: r[5] for r in rows if r[1] == s} for s in NAMES}
    for row in got:
        now, before = held[row.version_seq], held.get(row.version_seq - 1, {})
        assert row.row_count == len(now)
        assert row.added == len(now.keys() - before.keys())
        assert row.removed == len(before.keys() - now.keys())
        assert row.restated == sum(now[k] != before[k] for k in now.keys() & before.keys())
    assert len(got) == 6


def test_deltas_with_gaps_in_ordinals_and_blank_cells(spark):
    """Three versions numbered 10, 20, 30; one column is blank throughout."""
    rows = [("a", 10, None, 1), ("a", 20, None, 2), ("a", 30, None, 2), ("b", 10, None, 5), ("c", 30, None, 1)]
    df = spark.createDataFrame(rows, "key string, version_seq bigint, other bigint, value bigint")
    versions = spark.createDataFrame(
        [(s, str(s), "Major") for s in (10, 20, 30)],
        "version_seq bigint, version string, version_type string",
    )
    got = version_deltas(df, ["key"], "version_seq", {"restated": ["other", "value"]}, versions)
    found = {r.version_seq: (r.row_count, r.added, r.removed, r.restated) for r in got.collect()}
    assert found == {10: (2, 2, 0, 0), 20: (1, 0, 1, 1), 30: (2, 1, 0, 0)}


def test_reformatting_opens_text_records_only(spark):
    df = spark.createDataFrame(
        [("a", 1, "4", 4.0), ("a", 2, "4.0", 4.0), ("a", 3, "5", 5.0), ("b", 1, "c", None)],
        "key string, version_seq bigint, shown string, value double",
    )
    got = text_and_typed_records(df, ["key"], "version_seq", ["shown"], ["value"]).collect()
    assert [r.scd2_records for r in got] == [4, 3]


EXTRACTIONS = [
    ("1.0", "a", "2026-01-01", "1"),
    ("1.0", "a", "2026-01-02", "2"),
    ("1.0", "b", "2026-01-01", "3"),
    ("2.0", "a", "2026-01-01", "4"),
]


@pytest.mark.parametrize(
    ("scope", "kept"),
    [("key", {("1.0", "a", "2"), ("1.0", "b", "3"), ("2.0", "a", "4")}),
     ("version", {("1.0", "a", "2"), ("2.0", "a", "4")})],
)
def test_latest_extraction_scope(spark, scope, kept):
    df = spark.createDataFrame(
        EXTRACTIONS, "version string, key string, ingest_date string, value string"
    )
    got = latest_extraction(df, ["version", "key"], ["ingest_date"], scope=scope)
    assert {(r.version, r.key, r.value) for r in got.collect()} == kept


def test_same_day_copies_resolve_to_one_row(spark):
    copies = [("1.0", "a", "2026-01-01", str(i)) for i in range(50)]
    df = spark.createDataFrame(copies, "version string, key string, ingest_date string, value string")
    for n in (1, 7):
        got = latest_extraction(df.repartition(n), ["version", "key"], ["ingest_date"]).collect()
        assert [r.value for r in got] == ["9"]


def test_unknown_scope_is_refused(spark):
    df = spark.createDataFrame(EXTRACTIONS, "version string, key string, ingest_date string, v string")
    with pytest.raises(ValueError, match="scope"):
        latest_extraction(df, ["key"], ["ingest_date"], scope="row")


def test_restatements_need_only_the_keys_with_several_records(spark):
    from statledger.plans import lines as ln

    columns = "l_orderkey bigint, l_linenumber int, version string, version_seq bigint, published_at date, quantity bigint, quantity_status string"
    made = [
        (order, line, str(1990 + s), 1990 + s, date(1990 + s, 12, 31), value, "published" if value else "suppressed_low")
        for order, line, values in [(1, 1, [5]), (1, 2, [5, 5, 6]), (None, 1, [7, 8]), (2, None, [3]), (3, 1, [4, None, 4])]
        for s, value in enumerate(values)
    ]
    fact = scd2(spark.createDataFrame(made, columns), ln.KEY, ln.SEQ, ["quantity", "quantity_status"], version="version")
    records = ln.revised_records(fact)
    assert (fact.count(), records.count()) == (9, 7)
    told = [restatement_history(f, ln.KEY, "quantity").collect() for f in (fact, records)]
    assert len(told[0]) == 4 and sorted(map(str, told[0])) == sorted(map(str, told[1]))
