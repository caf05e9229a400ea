"""The command-line jobs end to end on a tiny release."""

import csv

import pytest

from statledger import EDUCATION_HEADLINE as SPEC
from statledger.jobs import main
from statledger.operators.quality import QualityGateError
from statledger.plans.warehouse import Warehouse
from statledger.sources.bronze import read_manifest
from statledger.sources.catalogue import read_metadata, read_versions


def write_release(path, starts):
    """National detail cells of two levels and the published total over them."""
    with open(path, "w", newline="") as out:
        rows = csv.writer(out)
        rows.writerow(SPEC.bronze_columns)
        for level, value in starts.items():
            others = ["Total"] * 4 if level == "Total" else ["x"] * 4
            rows.writerow(
                ["202425", "Academic year", "National", "E92000001", "England", "", "", level,
                 *others, value, "low", "z", "4.0", "c"]
            )


@pytest.fixture
def place(tmp_path):
    (tmp_path / "versions.csv").write_text(
        "version,version_type,published_at,total_results,version_seq\n"
        "1.0,Major,2025-07-25,3,1\n2.0,Major,2026-01-29,3,2\n"
    )
    higher, advanced = "Higher Apprenticeship", "Advanced Apprenticeship"
    write_release(tmp_path / "first.csv", {higher: "100", advanced: "low", "Total": "100"})
    write_release(tmp_path / "second.csv", {higher: "100", advanced: "60", "Total": "160"})
    return tmp_path


def test_land_load_and_check(spark, place, capsys):
    landing, root = str(place / "landing"), str(place / "tables")
    common = ["--landing", landing, "--root", root, "--versions", str(place / "versions.csv")]
    load = ["load", *common, "--checkpoint", str(place / "checkpoint")]
    for version, file in (("1.0", "first.csv"), ("2.0", "second.csv")):
        source = ["land", "--source", str(place / file), "--version", version]
        assert main([*source, "--ingest-date", "2026-08-20", "--landing", landing], spark) == 0
        assert main(load, spark) == 0
    house = Warehouse(spark, root, landing, read_versions(spark, str(place / "versions.csv")), SPEC)
    fact = house.fact()
    assert fact.count() == 5 and fact.filter("is_current").count() == 3
    first = fact.filter("valid_from_seq = 1 AND start_count_status = 'suppressed_low'").first()
    assert first.start_count is None and first.is_superseded
    assert main(["check", *common], spark) == 0
    assert "detail reconciles to published total" in capsys.readouterr().out

    before = sorted(map(str, fact.collect()))
    assert main(["build", *common], spark) == 0
    assert sorted(map(str, house.fact().collect())) == before


def test_check_reports_a_broken_total(spark, place, capsys):
    landing, root = str(place / "landing"), str(place / "tables")
    seed = place / "versions.csv"
    common = ["--landing", landing, "--root", root, "--versions", str(seed)]
    for version, file in (("1.0", "first.csv"), ("2.0", "second.csv")):
        source = ["land", "--source", str(place / file), "--version", version]
        main([*source, "--landing", landing], spark)
    main(["build", *common], spark)
    seed.write_text(seed.read_text().replace("2026-01-29,3", "2026-01-29,4"))
    assert main(["check", *common], spark) == 1
    out = capsys.readouterr().out
    assert "current records match newest version: 1" in out


def test_two_loaded_versions_must_both_be_in_the_lineage(spark, place):
    landing, root = str(place / "landing"), str(place / "tables")
    common = ["--landing", landing, "--root", root, "--versions", str(place / "versions.csv")]
    for version in ("1.0", "2.0"):
        source = ["land", "--source", str(place / "second.csv"), "--version", version]
        main([*source, "--landing", landing], spark)
    with pytest.raises(QualityGateError, match="at least two versions in lineage: 1"):
        main(["build", *common], spark)


def test_list_versions(spark, tmp_path, capsys):
    (tmp_path / "page.json").write_text(
        '{"results": [{"version": "1.0", "published": "2025-07-25T09:30:00Z"}]}'
    )
    assert main(["list-versions", "--pages", str(tmp_path)], spark) == 0
    assert "|2025-07-25|" in capsys.readouterr().out


def test_backfill_and_watch(spark, place, capsys):
    landing, seed = str(place / "landing"), str(place / "versions.csv")
    for name, version in (("first.csv", "1.0"), ("second.csv", "2.0")):
        (place / name).rename(place / f"{version}.csv")
    (place / "2.0.json").write_text('{"indicators": [{"id": "i", "label": "I", "unit": ""}]}')
    common = ["--releases", str(place), "--landing", landing, "--versions", seed]
    for action in ("extract", "skip"):
        assert main(["watch", *common, "--state", str(place / "state")], spark) == 0
        assert action in capsys.readouterr().out
    landed = {r.dataset_version for r in read_manifest(spark, landing).collect()}
    assert landed == {"2.0"}
    assert main(["backfill", *common, "--plain"], spark) == 0
    stored = {r.dataset_version: r for r in read_manifest(spark, landing).collect()}
    assert set(stored) == {"1.0", "2.0"} and stored["1.0"].row_count == 3
    assert spark.read.json(f"{landing}/_meta/manifest").count() == 2
    day = stored["2.0"].ingest_date
    assert read_metadata(spark, f"{landing}/_meta/version=2.0/ingest_date={day}").count() == 1
