"""Value, status, key and period of hand-made cells."""

import hashlib

import pytest
from pyspark.sql import functions as F

from statledger.functions import (
    academic_year,
    aggregation_depth,
    fingerprint,
    measure_status,
    measure_value,
    natural_key,
    per_mille,
    safe_divide,
)

CELLS = [
    ("1430", 1430, 1430.0, "published"),
    (" 4 ", 4, 4.0, "published"),
    ("\t7 ", 7, 7.0, "published"),
    ("-3", -3, -3.0, "published"),
    ("+3", 3, 3.0, "published"),
    ("4.0", None, 4.0, "published"),
    ("1e3", None, 1000.0, "published"),
    (".5", None, 0.5, "published"),
    ("low", None, None, "suppressed_low"),
    ("LOW ", None, None, "suppressed_low"),
    ("c", None, None, "suppressed_confidential"),
    ("Z", None, None, "not_applicable"),
    ("", None, None, "missing"),
    ("  ", None, None, "missing"),
    (None, None, None, "missing"),
    ("x", None, None, "unrecognised"),
    ("4d", None, None, "unrecognised"),
    ("NaN", None, None, "unrecognised"),
    ("inf", None, None, "unrecognised"),
    ("1 000", None, None, "unrecognised"),
    ("99999999999999999999", None, 1e20, "published"),
]


def test_value_and_status(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CELLS)], "i int, cell string")
    rows = df.select(
        "i",
        measure_value("cell").alias("whole"),
        measure_value("cell", "double").alias("real"),
        measure_status("cell").alias("status"),
    ).orderBy("i").collect()
    for row, (cell, whole, real, status) in zip(rows, CELLS, strict=True):
        assert (row.whole, row.real, row.status) == (whole, real, status), cell


def test_lenient_value_takes_whole_decimals(spark):
    df = spark.createDataFrame([("4.0",), ("1e3",), ("4.5",), ("low",), ("12",)], "cell string")
    got = [r[0] for r in df.select(measure_value("cell", "bigint", lenient=True)).collect()]
    assert got == [4, 1000, None, None, 12]


def test_markers_are_a_parameter(spark):
    df = spark.createDataFrame([("k",), ("low",)], "cell string")
    got = [r[0] for r in df.select(measure_status("cell", {"k": "suppressed_low"})).collect()]
    assert got == ["suppressed_low", "unrecognised"]


def test_depth_ignores_null(spark):
    df = spark.createDataFrame(
        [("Total", "Total"), ("Total", "a"), ("b", None), ("total", "c")], "p string, q string"
    )
    assert [r[0] for r in df.select(aggregation_depth(["p", "q"])).collect()] == [2, 1, 0, 0]


def test_academic_year(spark):
    df = spark.createDataFrame([("202425",), ("199900",)], "p string")
    rows = df.select(*academic_year("p")).collect()
    assert [tuple(r) for r in rows] == [(2024, 2025, "2024/25"), (1999, 2000, "1999/00")]


def test_natural_key_needs_every_part_without_default(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", "r", None)], "k string, r string, d string")
    keys = [r[0] for r in df.select(natural_key(["k", "r", "d"], {"r": "NA"})).collect()]
    assert keys == [hashlib.md5(b"a|NA|x").hexdigest(), None]


def test_fingerprint_marks_null(spark):
    df = spark.createDataFrame([("1", "low"), ("1", None)], "a string, b string")
    assert [r[0] for r in df.select(fingerprint(["a", "b"])).collect()] == ["1~low", "1~\x00"]


@pytest.mark.parametrize(
    ("a", "b", "share", "tenths"),
    [(1, 0, None, None), (1, 8, 0.125, 125), (None, 4, None, None), (1, 2000, 0.0005, 1)],
)
def test_division(spark, a, b, share, tenths):
    df = spark.createDataFrame([(a, b)], "a bigint, b bigint")
    row = df.select(safe_divide(F.col("a"), F.col("b")), per_mille(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (share, tenths)
