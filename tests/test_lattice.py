"""Reconciliation and disclosure over all subtotals, against plain Python on small cubes."""

from itertools import product

import numpy as np
import pytest

from statledger.operators import lattice

DIMS = ["a", "b", "c"]
SCHEMA = "area string, a string, b string, c string, n bigint, state string"


def cube(seed, hidden=0.2, base=1):
    """A cube's true counts, and its rows with some cells withheld and the rest rounded."""
    rng = np.random.default_rng(seed)
    members = {d: [f"{d}{k}" for k in range(3)] for d in DIMS}
    members["b"][2] = None
    true = {}
    for key in product(*members.values()):
        n = int(rng.integers(0, 40))
        for up in product((0, 1), repeat=3):
            cell = tuple("Total" if u else m for u, m in zip(up, key, strict=True))
            true[cell] = true.get(cell, 0) + n
    rows = []
    for cell, n in true.items():
        if n < 8 or rng.random() < hidden:
            rows.append((None, *cell, None, "low" if n < 8 else "c"))
        else:
            rows.append((None, *cell, (n + base // 2) // base * base, "published"))
    return true, rows


def plain_bounds(rows, base, rounds, ceiling=7):
    half = base // 2
    low = {r[1:4]: max(r[4] - half, 0) if r[4] is not None else 0 for r in rows}
    high = {r[1:4]: r[4] + half if r[4] is not None else ceiling if r[5] == "low" else np.inf for r in rows}
    for _ in range(rounds):
        for d in range(3):
            lines = {}
            for cell in low:
                lines.setdefault(cell[:d] + cell[d + 1 :], []).append(cell)
            for line in lines.values():
                up = [c for c in line if c[d] == "Total"]
                down = [c for c in line if c[d] != "Total"]
                if not up or high[up[0]] < sum(low[c] for c in down) or low[up[0]] > sum(high[c] for c in down):
                    continue
                old_low, old_high = dict(low), dict(high)
                for c in down:
                    others = [x for x in down if x != c]
                    low[c] = max(old_low[c], old_low[up[0]] - sum(old_high[x] for x in others))
                    high[c] = min(old_high[c], old_high[up[0]] - sum(old_low[x] for x in others))
                low[up[0]] = max(low[up[0]], sum(old_low[c] for c in down))
                high[up[0]] = min(high[up[0]], sum(old_high[c] for c in down))
    return low, high


@pytest.mark.parametrize(("seed", "base", "rounds"), [(1, 1, 1), (2, 1, 3), (3, 10, 2)])
def test_bounds_hold_the_truth_and_equal_plain_python(spark, seed, base, rounds):
    true, rows = cube(seed, base=base)
    cells = spark.createDataFrame(rows, SCHEMA)
    found = lattice.withheld_bounds(
        cells, DIMS, ["area"], "n", "state", ceilings={"low": 7}, base=base, rounds=rounds
    ).collect()
    low, high = plain_bounds(rows, base, rounds)
    assert len(found) == sum(r[4] is None for r in rows) > 10
    for r in found:
        cell = (r.a, r.b, r.c)
        assert (r.least, np.inf if r.most is None else r.most) == (low[cell], high[cell])
        assert r.least <= true[cell] <= (np.inf if r.most is None else r.most)
    if base == 1:
        assert any(r.revealed for r in found) and all(r.least == true[r.a, r.b, r.c] for r in found if r.revealed)


def test_one_withheld_member_is_revealed(spark):
    rows = [("x", "a0", 30, "published"), ("x", "a1", None, "c"), ("x", "Total", 75, "published")]
    rows += [("y", "a0", None, "c"), ("y", "a1", None, "c"), ("y", "Total", 75, "published"), ("z", "a0", None, "c")]
    cells = spark.createDataFrame(rows, "area string, a string, n bigint, state string")
    bounds = lattice.withheld_bounds(cells, ["a"], ["area"], "n", "state", base=1)
    got = {(r.area, r.a): (r.least, r.most, r.narrowed, r.revealed) for r in bounds.collect()}
    assert got["x", "a1"] == (45, 45, True, True)
    assert got["y", "a0"] == got["y", "a1"] == (0, 75, True, False)
    assert got["z", "a0"] == (0, None, False, False)
    report = {r.area: tuple(r)[1:] for r in lattice.disclosure_report(bounds, ["area"]).collect()}
    assert report == {"x": (1, 1, 1), "y": (2, 2, 0), "z": (1, 0, 0)}
    assert lattice.withheld_bounds(cells.limit(0), ["a"], ["area"], "n", "state").count() == 0


def test_contradicting_figures_change_no_bound(spark):
    rows = [("a0", 90, "published"), ("a1", None, "c"), ("Total", 75, "published")]
    cells = spark.createDataFrame(rows, "a string, n bigint, state string")
    (only,) = lattice.withheld_bounds(cells, ["a"], [], "n", "state", base=1).collect()
    assert (only.least, only.most, only.narrowed) == (0, None, False)
    (failed,) = lattice.check_lattice(cells, ["a"], [], "n", "state", base=1).collect()
    assert (failed.published, failed.detail_sum, failed.verdict) == (75, 90, lattice.BELOW)


@pytest.mark.parametrize("base", [1, 10])
def test_planted_breaks_are_found(spark, base):
    true, rows = cube(5, hidden=0.0, base=base)
    named = dict(ceilings={"low": 7}, base=base)
    clean = spark.createDataFrame(rows, SCHEMA)
    every = lattice.reconcile_lattice(clean, DIMS, ["area"], "n", "state", **named)
    subtotals = [r for r in rows if "Total" in r[1:4] and r[4] is not None]
    assert every.count() == len(subtotals)
    assert lattice.check_lattice(clean, DIMS, ["area"], "n", "state", **named).isEmpty()
    planted = {r[1:4]: 400 * (1 if k % 2 else -1) for k, r in enumerate(subtotals[::5])}
    broken = [(*r[:4], r[4] + planted.get(r[1:4], 0) if r[4] is not None else None, r[5]) for r in rows]
    found = lattice.check_lattice(
        spark.createDataFrame(broken, SCHEMA), DIMS, ["area"], "n", "state", **named
    ).collect()
    verdicts = {(r.a, r.b, r.c): r.verdict for r in found}
    assert verdicts == {c: lattice.ABOVE if x > 0 else lattice.BELOW for c, x in planted.items()}


def test_one_shuffle_for_all_grouping_sets_and_two_a_round(spark):
    _, rows = cube(7)
    cells = spark.createDataFrame(rows, SCHEMA)

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(lattice.reconcile_lattice(cells, DIMS, ["area"], "n", "state")) == 1
    assert exchanges(lattice.withheld_bounds(cells, DIMS, ["area"], "n", "state", rounds=2)) == 4
