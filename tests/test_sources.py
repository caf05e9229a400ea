"""Landing, manifests, publisher metadata and published tables."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from statledger.sources import bronze, catalogue
from statledger.sources.catalogue import IncompletePages, complete_pages, page_problems
from statledger.sources.tables import publish_table, read_table, stage_table, table_path

COLUMNS = ["place", "start_count"]


@pytest.fixture
def landing(spark, tmp_path):
    base = str(tmp_path / "landing")
    first = spark.createDataFrame([("a", "10"), ("b", "low")], "place string, start_count string")
    bronze.land(first, base, "1.0", "2026-01-01")
    bronze.land(first, base, "2.0", "2026-01-02")
    return base


def test_versions_stay_text(spark, landing):
    df = bronze.read_bronze(spark, landing, COLUMNS)
    assert dict(df.dtypes)["version"] == "string"
    assert {r.version for r in df.select("version").collect()} == {"1.0", "2.0"}
    assert df.filter("version = '1.0'").first().ingest_date == date(2026, 1, 1)


def test_version_filter_prunes_folders(spark, landing):
    df = bronze.read_bronze(spark, landing, COLUMNS).filter(F.col("version") == "2.0")
    assert all("version=2.0" in f for f in {r[0] for r in df.select(F.input_file_name()).collect()})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan


def test_quoting_blanks_and_line_breaks(spark, tmp_path):
    folder = tmp_path / "data" / "version=1.0" / "ingest_date=2026-01-01"
    folder.mkdir(parents=True)
    (folder / "data.csv").write_text('place,start_count\n"a ""q"" b\nc",4\n,low\n')
    rows = bronze.read_bronze(spark, str(tmp_path), COLUMNS).collect()
    assert [(r.place, r.start_count) for r in rows] == [('a "q" b\nc', "4"), (None, "low")]


def test_text_survives_landing(spark, tmp_path):
    cells = [('say "hi"', "4.0"), ("two\nlines", "low"), ("a,b", None), ("back\\slash", "z")]
    df = spark.createDataFrame(cells, "place string, start_count string")
    bronze.land(df, str(tmp_path), "1.0", "2026-01-01")
    got = bronze.read_bronze(spark, str(tmp_path), COLUMNS).select(*COLUMNS).collect()
    assert {tuple(r) for r in got} == set(cells)


def test_same_day_landing_replaces_and_later_day_adds(spark, landing):
    again = spark.createDataFrame([("a", "20")], "place string, start_count string")
    bronze.land(again, landing, "2.0", "2026-01-02")
    df = bronze.read_bronze(spark, landing, COLUMNS)
    assert [r.start_count for r in df.filter("version = '2.0'").collect()] == ["20"]
    assert df.filter("version = '1.0'").count() == 2
    bronze.land(again, landing, "2.0", "2026-01-03")
    assert bronze.read_bronze(spark, landing, COLUMNS).filter("version = '2.0'").count() == 2


def test_landing_day_defaults_to_utc_today(spark, tmp_path):
    df = spark.createDataFrame([("a", "1")], "place string, start_count string")
    bronze.land(df, str(tmp_path), "1.0")
    assert bronze.read_bronze(spark, str(tmp_path), COLUMNS).first().ingest_date == bronze.utc_today()


def test_large_version_is_split_over_files(spark, tmp_path):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("place"), F.lit("1").alias("start_count")
    )
    bronze.land(df, str(tmp_path), "1.0", "2026-01-01", rows_per_file=100)
    assert len(list(Path(tmp_path).rglob("*.csv"))) >= 10
    assert bronze.read_bronze(spark, str(tmp_path), COLUMNS).count() == 1000


def test_manifest_counts_rows_not_lines(spark, tmp_path):
    folder = tmp_path / "data" / "version=1.0" / "ingest_date=2026-01-01"
    folder.mkdir(parents=True)
    content = 'place,start_count\n"x\ny",4\nb,low\n'
    (folder / "data.csv").write_text(content)
    row = bronze.manifest(spark, str(tmp_path), COLUMNS, "set").first()
    assert (row.dataset_id, row.dataset_version, row.row_count) == ("set", "1.0", 2)
    assert (row.files, row.bytes) == (1, len(content))
    file = bronze.file_manifest(spark, str(tmp_path), COLUMNS).first()
    assert (file.bytes, file.row_count, file.digest) == (len(content), 2, row.digest)


def test_metadata_stays_out_of_the_scan(spark, landing):
    document = spark.createDataFrame(
        [([("place", "Place", [("a", "A")])],)],
        "filters array<struct<id: string, label: string, options: array<struct<id: string, label: string>>>>",
    )
    path = bronze.store_metadata(document, landing, "1.0", "2026-01-01")
    loads = bronze.manifest(spark, landing, COLUMNS)
    assert {r.dataset_version: r.row_count for r in loads.collect()} == {"1.0": 2, "2.0": 2}
    assert bronze.read_bronze(spark, landing, COLUMNS).count() == 4
    labels = catalogue.metadata_labels(catalogue.read_metadata(spark, path)).collect()
    assert [tuple(r) for r in labels] == [("filter", "place", "a", "A")]


def test_manifest_checksum_follows_content(spark, landing):
    sums = {
        r.dataset_version: r.digest
        for r in bronze.manifest(spark, landing, COLUMNS).collect()
    }
    assert sums["1.0"] == sums["2.0"]
    other = spark.createDataFrame([("a", "10"), ("b", "z")], "place string, start_count string")
    bronze.land(other, landing, "2.0", "2026-01-02")
    changed = {
        r.dataset_version: r.digest
        for r in bronze.manifest(spark, landing, COLUMNS).collect()
    }
    assert changed["1.0"] == sums["1.0"] != changed["2.0"]


def landed_digest(spark, base, rows):
    df = spark.createDataFrame(rows, "place string, start_count string")
    bronze.land(df, str(base), "1.0", "2026-01-01")
    return bronze.manifest(spark, str(base), COLUMNS).first().digest


def test_digest_counts_twin_rows_and_tells_columns_apart(spark, tmp_path):
    rows = [("a", "4"), ("b", "5")]
    twins = [*rows, ("c", "6"), ("c", "6")]
    assert landed_digest(spark, tmp_path / "a", rows) != landed_digest(spark, tmp_path / "b", twins)
    left = landed_digest(spark, tmp_path / "c", [("x", None)])
    assert left != landed_digest(spark, tmp_path / "d", [(None, "x")])


def test_loads_are_recorded_once_each(spark, landing):
    first = bronze.record_load(spark, landing, COLUMNS, "1.0", "2026-01-01").first()
    bronze.record_load(spark, landing, COLUMNS, "2.0", "2026-01-02")
    stored = {r.dataset_version: r for r in bronze.read_manifest(spark, landing).collect()}
    assert stored["1.0"].ingested_at == first.ingested_at < stored["2.0"].ingested_at
    again = bronze.record_load(spark, landing, COLUMNS, "1.0", "2026-01-01").first()
    stored = {r.dataset_version: r for r in bronze.read_manifest(spark, landing).collect()}
    assert stored["1.0"].ingested_at == again.ingested_at > first.ingested_at
    assert spark.read.json(f"{landing}/_meta/manifest").count() == 3


def test_plain_files_split(spark, tmp_path):
    (tmp_path / "big.csv").write_text("place,start_count\n" + "aaaaaaaaaa,5\n" * 200_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        for plain, tasks in ((True, 4), (False, 1)):
            base = str(tmp_path / f"landing{plain}")
            args = (str(tmp_path / "big.csv"), base, COLUMNS, "1.0", "2026-01-01")
            bronze.land_files(spark, *args, quoted_newlines=not plain)
            rows = bronze.read_bronze(spark, base, COLUMNS, quoted_newlines=not plain)
            assert rows.count() == 200_000
            assert (rows.rdd.getNumPartitions() >= tasks) and (plain or rows.rdd.getNumPartitions() >= 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_manifest_reconciles_with_declared_totals(spark, landing):
    versions = spark.createDataFrame(
        [("1.0", "Major", date(2025, 1, 1), 2, 1), ("2.0", "Major", date(2025, 2, 1), 3, 2)],
        catalogue.VERSIONS_SCHEMA,
    )
    loads = bronze.manifest(spark, landing, COLUMNS)
    got = bronze.manifest_reconcile(loads, versions).collect()
    assert {r.dataset_version: r.matches for r in got} == {"1.0": True, "2.0": False}


def test_version_pages_with_absent_fields(spark, tmp_path):
    pages = [
        {
            "results": [
                {
                    "version": "2.0",
                    "type": "Major",
                    "status": "Published",
                    "published": "2026-01-29T09:30:00Z",
                    "totalResults": 5,
                    "timePeriods": {"start": "2017/18", "end": "2025/26"},
                },
                {"version": "1.1"},
            ],
            "paging": {"page": 1, "totalPages": 2},
        },
        {
            "results": [{"version": "1.0", "timePeriods": {"start": "2017/18"}}],
            "paging": {"page": 2, "totalPages": 2},
        },
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps(page, indent=2))
    history = catalogue.version_history(catalogue.version_pages(spark, str(tmp_path)))
    rows = {r.version: r for r in history.collect()}
    assert rows["1.1"][1:] == ("", "", "", 0, "", "")
    assert rows["1.0"].time_period_start == "2017/18" and rows["1.0"].time_period_end == ""
    listing = {r.version: r for r in catalogue.version_listing(history).collect()}
    assert listing["2.0"].published == "2026-01-29"
    assert listing["2.0"].periods == "2017/18..2025/26"


def test_result_pages(spark, tmp_path):
    pages = [
        {"results": [{"place": "a", "start_count": "10"}, {"place": "b", "start_count": "low"}]},
        {"results": []},
        {"results": [{"place": "a", "start_count": "c"}]},
    ]
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, pages)))
    df = catalogue.result_pages(spark, str(tmp_path), COLUMNS)
    assert catalogue.query_rows(df).count() == 3
    got = catalogue.query_rows(df, F.col("place") == "a", ["start_count"]).collect()
    assert sorted(r.start_count for r in got) == ["10", "c"]


def test_decisions(spark):
    versions = spark.createDataFrame(
        [("9.0", "Major", date(2025, 1, 1), 2, 1), ("10.0", "Major", date(2025, 2, 1), 3, 2)],
        catalogue.VERSIONS_SCHEMA,
    )
    actions = {
        seen: catalogue.decide(versions, seen).first().action for seen in (None, "9.0", "10.0")
    }
    assert actions == {None: "extract", "9.0": "extract", "10.0": "skip"}
    assert catalogue.decide(versions, None).first().latest_version == "10.0"


def test_published_table_keeps_types_and_runs(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("2.0", 2001, 1), ("1.0", 2000, 2)], "v string, y bigint, n int")
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, "silver", "t")
    first = stage_table(df, root, "silver", "t", 0, partition_by=("v", "y"))
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, "silver", "t")
    publish_table(first, root, "silver", "t", 0)
    got = read_table(spark, root, "silver", "t")
    assert dict(got.dtypes) == dict(df.dtypes)
    assert {r.v for r in got.collect()} == {"1.0", "2.0"}
    more = stage_table(df.limit(1), root, "silver", "t", 1, partition_by=("v", "y"))
    publish_table(more, root, "silver", "t", 1, full=False)
    assert read_table(spark, root, "silver", "t").count() == 3
    anew = stage_table(df.limit(1), root, "silver", "t", 2, partition_by=("v", "y"))
    publish_table(anew, root, "silver", "t", 2)
    assert read_table(spark, root, "silver", "t").count() == 1


def test_layers_are_known():
    assert table_path("/r", "gold", "t") == "/r/gold/t"
    with pytest.raises(ValueError, match="layer"):
        table_path("/r", "platinum", "t")


def pages_of(spark, rows):
    schema = "doc string, results array<string>, paging struct<page: int, totalPages: int>"
    return spark.createDataFrame([(d, [], (p, n)) for d, p, n in rows], schema)


def test_missing_and_repeated_pages_are_found(spark):
    whole = [("a", 1, 3), ("a", 2, 3), ("a", 3, 3), ("b", 1, 1)]
    assert page_problems(pages_of(spark, whole), ["doc"]).isEmpty()
    assert complete_pages(pages_of(spark, whole), ["doc"]).count() == 4
    faulty = [("a", 1, 3), ("a", 3, 3), ("a", 3, 3), ("b", 1, 1), ("b", 2, 1), ("c", None, 2), ("d", 4, None)]
    found = {tuple(r) for r in page_problems(pages_of(spark, faulty), ["doc"]).collect()}
    assert found == {
        ("a", 2, "missing", 0), ("a", 3, "repeated", 2), ("b", 2, "beyond", 1), ("c", None, "unnumbered", 1),
        ("c", 1, "missing", 0), ("c", 2, "missing", 0), ("d", 4, "beyond", 1),
    }
    with pytest.raises(IncompletePages, match="page 2 missing"):
        complete_pages(pages_of(spark, faulty), ["doc"])
    assert page_problems(pages_of(spark, [])).isEmpty()


def test_pages_of_one_document(spark):
    found = page_problems(pages_of(spark, [("x", 1, 4), ("y", 2, 4), ("x", 4, 4), ("y", 4, 4)])).collect()
    assert sorted((r["page"], r["problem"]) for r in found) == [(3, "missing"), (4, "repeated")]
