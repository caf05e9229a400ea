"""Totals moved by change sets against totals computed anew."""

import random

import pytest
from pyspark.sql import functions as F
from test_history import NAMES, random_rows, release
from test_ledger import frame, fresh, listed, of

from statledger.plans import ledger as module
from statledger.plans.totals import RunningTotals, group_state, shown_totals


def anew(kept, group=("name",)):
    current = kept.records().where("is_current")
    return listed(shown_totals(group_state(current, group, ["value"]), group, ["value"]))


def named(rows, seed):
    """The same rows, spread over groups that a key may change between versions."""
    rng = random.Random(seed)
    return [(*r[:4], rng.choice(["north", "south", "gone" if r[1] < 3 else "west"]), *r[5:]) for r in rows]


def test_totals_after_each_of_six_loads(spark, monkeypatch):
    seed = 1
    monkeypatch.setattr(module, "MERGE_SHARE", 1.2)
    rows = named(random_rows(seed, keys=40), seed)
    order = list(NAMES)
    random.Random(seed).shuffle(order)
    kept = fresh(spark)
    totals = RunningTotals(kept, f"{kept.root}/totals", ["name"], ["value"])
    took = []
    for seq in order:
        kept.load(frame(spark, of(rows, seq)))
        took.append(totals.refresh())
        assert listed(totals.totals()) == anew(kept)
    assert took[0] == "recomputed" and "moved" in took


def test_withheld_only_is_null_and_empty_groups_go(spark, monkeypatch):
    monkeypatch.setattr(module, "MERGE_SHARE", 1e9)
    kept = fresh(spark)
    totals = RunningTotals(kept, f"{kept.root}/totals", ["name"], ["value"])
    assert totals.refresh() == "nothing"
    with pytest.raises(FileNotFoundError):
        totals.totals()
    kept.load(frame(spark, [release("a", 1, 5, "x"), release("b", 1, None, "x"), release("c", 1, 7, "y")]))
    totals.refresh()
    kept.load(frame(spark, [release("a", 2, None, "x"), release("b", 2, None, "x")]))
    assert totals.refresh() == "moved"
    assert [tuple(r) for r in totals.totals().collect()] == [("x", 2, None, 2, 1.0)]
    assert totals.refresh() == "nothing"


def test_a_merge_needs_no_new_totals(spark, monkeypatch):
    monkeypatch.setattr(module, "MERGE_SHARE", 1e9)
    rows = random_rows(3, keys=20)
    kept = fresh(spark)
    totals = RunningTotals(kept, f"{kept.root}/totals", ["name", "parity"], ["value"], {"parity": F.length("key") % 2})
    for seq in (1, 2):
        kept.load(frame(spark, of(rows, seq)))
        totals.refresh()
    kept.merge()
    assert totals.refresh() == "relabelled"
    kept.load(frame(spark, of(rows, 3)))
    assert totals.refresh() == "moved"
    current = kept.records().where("is_current").withColumn("parity", F.length("key") % 2)
    group = ["name", "parity"]
    assert listed(totals.totals()) == listed(shown_totals(group_state(current, group, ["value"]), group, ["value"]))
