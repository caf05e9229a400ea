"""Marts, checks, forecasts and clusters on small inputs, against plain Python."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from statledger.operators import clusters, marts, profile, quality
from statledger.operators.forecast import drift_forecast, fill_steps, holdout_check, order_forecast
from statledger.operators.quantile import nth_smallest
from statledger.plans.standin import SPEC

FACT = (
    "academic_year_start bigint, academic_year_label string, is_provisional boolean, "
    "geographic_level string, region_code string, region_name string, market_segment string, "
    "aggregation_depth int, is_detail_grain boolean, is_current boolean, start_count bigint, "
    "start_count_status string, achievement_count bigint, participation_count bigint"
)


def cell(year, region, segment, starts, achieved=None, depth=0, current=True):
    area = ("Regional", region[0], region) if region else ("National", None, None)
    status = "published" if starts is not None else "suppressed_low"
    return (year, f"{year}/x", year == 2001, *area, segment, depth, depth == 0, current, starts,
            status, achieved, None)


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [
            cell(2000, "ASIA", "BUILDING", None),
            cell(2000, "ASIA", "BUILDING", None),
            cell(2000, "EUROPE", "BUILDING", 30, 20),
            cell(2000, "EUROPE", "BUILDING", None, 10),
            cell(2000, "EUROPE", "FURNITURE", 0, 5),
            cell(2000, "EUROPE", "Total", 500, depth=5),
            cell(2000, "EUROPE", "BUILDING", 700, current=False),
            cell(2000, None, "BUILDING", 100),
            cell(2000, None, "FURNITURE", 300),
            cell(2000, None, "Total", 400, depth=5),
            cell(2001, None, "BUILDING", 150),
            cell(2001, None, "FURNITURE", 150),
            cell(2001, None, "Total", 310, depth=5),
        ],
        FACT,
    )


def test_withheld_groups_are_null_not_zero(fact):
    got = {(r.region_name, r.market_segment): r for r in marts.regional_trends(fact, SPEC).collect()}
    asia = got["ASIA", "BUILDING"]
    assert asia.starts is None and asia.achievement_ratio is None
    assert (asia.start_rows_published, asia.start_rows_suppressed, asia.suppression_rate) == (0, 2, 1.0)
    europe = got["EUROPE", "BUILDING"]
    assert (europe.starts, europe.achievements, europe.achievement_ratio) == (30, 30, 1.0)
    assert got["EUROPE", "FURNITURE"].achievement_ratio is None
    assert ("EUROPE", "Total") not in got


def test_level_shift_against_own_first_year(fact):
    rows = marts.level_shift(fact, SPEC).filter("geographic_level = 'National'").collect()
    got = {(r.academic_year_start, r.market_segment): r for r in rows}
    assert got[2000, "BUILDING"].level_share == 0.25
    assert got[2000, "BUILDING"].share_change_vs_baseline == 0
    assert got[2001, "BUILDING"].share_change_vs_baseline == 0.25
    assert got[2001, "BUILDING"].area_year_starts == 300


def test_reconciliation_tolerance(fact):
    got = {r.academic_year_start: r for r in profile.reconcile(fact, SPEC).collect()}
    assert got[2000].within_tolerance and got[2000].difference == 0
    assert not got[2001].within_tolerance and got[2001].difference == -10
    failing = quality.check_reconciliation(fact, SPEC).collect()
    assert [r.academic_year_start for r in failing] == [2001]
    assert quality.check_reconciliation(fact, SPEC, tolerance=0.05).isEmpty()


def test_prompts_say_withheld(spark, fact):
    facts = marts.region_narrative_facts(marts.regional_trends(fact, SPEC), SPEC)
    text = {r.region_name: r.prompt for r in marts.region_prompts(facts, SPEC).collect()}
    assert "2000/01 starts: WITHHELD" in text["ASIA"]
    assert "1995/96 starts: WITHHELD" in text["EUROPE"]
    assert "2000/01 starts: 30" in text["EUROPE"]
    assert "withheld for disclosure control: 2 of 2" in text["ASIA"]


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, "published"), ("a", 1, "unrecognised"), (None, 9, "missing")],
        "k string, n int, start_count_status string",
    )
    assert quality.check_not_null(df, "k").count() == 1
    assert quality.check_unique(df, ["k", "n"]).first().copies == 2
    assert quality.check_values(df, "start_count_status", ["published", "missing"]).count() == 1
    assert quality.check_range(df, "n", 0, 5).first().n == 9
    assert quality.check_rows(df, quality.unrecognised(["start_count"])).count() == 1
    parents = spark.createDataFrame([("b",)], "id string")
    assert quality.check_relationship(df, "k", parents, "id").count() == 2
    counted = quality.count_failures(df, {"null": quality.not_null("k"), "far": F.col("n") > 99})
    report = quality.dq_report({"unique": quality.check_unique(df, ["k", "n"])}, [counted])
    assert {r.check: r.failing_rows for r in report.collect()} == {"null": 1, "far": 0, "unique": 1}
    quality.gate(report, allowed=("null", "unique"))
    with pytest.raises(quality.QualityGateError, match="null: 1, unique: 1"):
        quality.gate(report)


def test_published_without_value_is_reported(spark):
    df = spark.createDataFrame(
        [(None, "published"), (4, "published"), (5, "suppressed_low")],
        "n bigint, n_status string",
    )
    assert quality.check_rows(df, quality.published_without_value("n")).count() == 1
    assert quality.check_rows(df, quality.valued_but_withheld("n")).first().n == 5


def test_identifier_columns(spark):
    tables = {
        "people": spark.createDataFrame([("x", 1), (None, 2)], "Home_Address string, n int"),
        "plain": spark.createDataFrame([(1,)], "n int"),
    }
    found = quality.identifier_columns(tables)
    assert [tuple(r) for r in found.collect()] == [("people", "Home_Address", 1)]
    assert quality.identifier_summary(found).first()[0] == "Home_Address"
    tables["plain"].createOrReplaceTempView("plain_view")
    assert quality.database_tables(spark, "default")["plain_view"].columns == ["n"]
    none = quality.identifier_columns({"plain": tables["plain"]})
    assert none.isEmpty() and quality.identifier_summary(none).first()[0] is None


SERIES = {"up": [0.1, 0.14, 0.2, 0.21, 0.27], "flat": [0.5, 0.5, 0.5], "pair": [0.2, 0.3]}


@pytest.mark.parametrize("drift_error", [False, True])
def test_drift_forecast(spark, drift_error):
    cells = [(g, 2000 + i, y) for g, ys in SERIES.items() for i, y in enumerate(ys)]
    cells.append(("single", 2000, 0.4))
    df = spark.createDataFrame(cells, "g string, t bigint, y double")
    got = {
        (r.g, r.h): r for r in drift_forecast(df, "g", "t", "y", drift_error=drift_error).collect()
    }
    assert len(got) == 12
    for g, ys in SERIES.items():
        steps = [b - a for a, b in zip(ys, ys[1:])]
        drift = (ys[-1] - ys[0]) / (len(ys) - 1)
        for h in range(1, 5):
            row = got[g, h]
            assert row.t == 2000 + len(ys) - 1 + h
            assert row.forecast == pytest.approx(ys[-1] + drift * h)
            if len(steps) < 2:
                assert row.lower is None
                continue
            spread = h + h * h / (len(ys) - 1) if drift_error else h
            margin = 1.959963984540054 * statistics.stdev(steps) * math.sqrt(spread)
            assert row.upper - row.forecast == pytest.approx(margin, abs=1e-12)
    actual = spark.createDataFrame([("up", 2005, 0.3), ("flat", 2003, 0.9)], "g string, t bigint, y double")
    held = holdout_check(drift_forecast(df, "g", "t", "y"), actual, "g", "t", "y").collect()
    assert {r.g: r.in_interval for r in held} == {"up": True, "flat": False}


def blobs(n=200):
    dice = np.random.default_rng(3)
    points = np.concatenate([dice.normal(c, 0.3, (n, 2)) for c in ((0, 0), (8, 0), (0, 8))])
    far = np.array([[30.0, 30.0], [-25.0, 4.0]])
    return np.concatenate([points, far])


def test_segments_recover_groups(spark):
    points = blobs()[:-2]
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double")
    got = clusters.kmeans_segments(df, ["x", "y"], k=3).toPandas()
    for centre in ((0, 0), (8, 0), (0, 8)):
        near = got[np.hypot(got.x - centre[0], got.y - centre[1]) < 3]
        assert near.segment.nunique() == 1


def test_gap_years_count_zero_up_to_a_common_end(spark):
    df = spark.createDataFrame([("a", 1, 4), ("a", 3, 6), ("b", 4, 1)], "g string, t bigint, y bigint")
    filled = {(r.g, r.t): r.y for r in fill_steps(df, "g", "t", "y", 5).collect()}
    assert filled == {("a", 1): 4, ("a", 2): 0, ("a", 3): 6, ("a", 4): 0, ("a", 5): 0, ("b", 4): 1, ("b", 5): 0}
    ahead = drift_forecast(fill_steps(df, "g", "t", "y", 5), "g", "t", "y", horizon=1).collect()
    assert {r.g: (r.t, r.drift) for r in ahead} == {"a": (6, -1.0), "b": (6, -1.0)}


def test_two_rows_of_one_step_are_refused(spark):
    df = spark.createDataFrame([("a", 1, 4), ("a", 1, 5), ("a", 2, 6)], "g string, t bigint, y bigint")
    with pytest.raises(Exception, match="more than one row for a g and t"):
        drift_forecast(df, "g", "t", "y").collect()


def test_anomalies_keep_their_keys(spark):
    df = spark.createDataFrame([(f"k{i}", float(i % 7), float(i)) for i in range(60)], "k string, x double, y double")
    got = clusters.anomaly_flags(df, ["x", "y"], k=2, keep=["k"]).collect()
    assert {(r.k, r.y) for r in got} == {(f"k{i}", float(i)) for i in range(60)}


def test_anomalies_against_brute_force(spark):
    points = blobs()
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double")
    # Run until the centres stop, so that they are the means of their segments.
    scored = clusters.anomaly_flags(df, ["x", "y"], k=3, contamination=0.02, maxIter=200, tol=0.0)
    got = scored.toPandas()
    scaled = (got[["x", "y"]] - got[["x", "y"]].mean()) / got[["x", "y"]].std()
    centres = scaled.groupby(got.segment).mean()
    gaps = {
        s: np.sqrt(((scaled - c) ** 2).sum(axis=1)) for s, c in centres.iterrows()
    }
    radius = {s: math.sqrt((gaps[s][got.segment == s] ** 2).mean()) for s in gaps}
    want = np.min([gaps[s] / radius[s] for s in gaps], axis=0)
    assert np.allclose(got.normalized_distance, want, atol=1e-6)
    cut = np.sort(want)[math.ceil(len(want) * 0.98) - 1]
    assert set(got.index[got.is_anomaly]) == set(np.flatnonzero(want > cut + 1e-9))
    assert got.is_anomaly.sum() == 12


@pytest.mark.parametrize("shape", ["spread", "ties", "two"])
def test_nth_smallest(spark, shape):
    dice = np.random.default_rng(5)
    values = {
        "spread": dice.normal(0, 1, 5000) ** 3,
        "ties": dice.integers(0, 7, 5000).astype(float),
        "two": np.repeat([1.0, 2.0], 2500),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
    order = np.sort(values)
    for n in (1, 2, 700, 2500, 2501, 4900, 5000):
        assert nth_smallest(df, "v", n, few=40) == order[n - 1], n
    assert nth_smallest(df, "v", 0) is None and nth_smallest(df, "v", 5001) is None


def test_anomalies_of_equal_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 20, "x double, y double")
    got = clusters.anomaly_flags(df, ["x", "y"], k=2).toPandas()
    assert not got.is_anomaly.any() and (got.normalized_distance == 0).all()


def plain_order(values):
    """(d, p) of least criterion, by a library's least squares."""
    y = np.array(values)
    best = []
    for d in (0, 1):
        v = np.diff(y, n=d)
        target = v[3 - d :]
        for p in range(3):
            lags = [v[3 - d - k : len(v) - k] for k in range(1, p + 1)]
            design = np.column_stack([np.ones(len(target)), *lags])
            rest = target - design @ np.linalg.lstsq(design, target, rcond=None)[0]
            n = len(target)
            best.append((n * np.log(rest @ rest / n) + (p + 1) * np.log(n), d, p))
    return min(best)[1:]


def test_order_search(spark):
    rng, rows, wanted = np.random.default_rng(4), [], {}
    for k in range(20):
        noise = rng.normal(size=400)
        v = np.zeros(400)
        a, b = [(0, 0), (0.7, 0), (0.5, -0.6), (0, 0), (0.6, 0)][k % 5]
        for i in range(2, 400):
            v[i] = a * v[i - 1] + b * v[i - 2] + noise[i]
        y = np.cumsum(v + 0.1) if k % 5 > 2 else v + 50
        wanted[k] = [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)][k % 5], plain_order(y)
        rows += [(k, i, float(x)) for i, x in enumerate(y)]
    rows += [(100, i, 7.0) for i in range(12)] + [(101, i, float(i % 4)) for i in range(9)]
    rows += [(102, i, 3.0 * i) for i in range(12)]
    found = {}
    for r in order_forecast(spark.createDataFrame(rows, "g int, t bigint, y double"), "g", "t", "y").collect():
        found.setdefault(r["g"], {})[r["h"]] = r
    assert found.keys() == {*wanted, 100, 102} and all(len(f) == 4 for f in found.values())
    orders = {k: (f[1]["d"], f[1]["p"]) for k, f in found.items()}
    assert {k: orders[k] for k in wanted} == {k: plain for k, (_, plain) in wanted.items()}
    assert sum(orders[k] == made for k, (made, _) in wanted.items()) >= 18
    assert [found[100][h]["forecast"] for h in (1, 4)] == [7.0, 7.0] and found[100][4]["upper"] == 7.0
    assert orders[102] == (0, 1) and found[102][4]["forecast"] == 45.0  # a line fits both, the lower d is taken
    # Errors of a random walk add up, those of noise don't.
    widths = {k: [f[h]["upper"] - f[h]["forecast"] for h in (1, 4)] for k, f in found.items()}
    assert abs(widths[3][1] / widths[3][0] - 2) < 1e-9 and widths[0][0] == widths[0][1]
