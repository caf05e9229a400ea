"""The stand-in through every layer, loads triggered by files, and the gate."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from statledger import session
from statledger.operators import quality
from statledger.operators.silver import to_silver
from statledger.plans.standin import RELEASES, SPEC, Standin
from statledger.plans.warehouse import SILVER, Warehouse
from statledger.session import scratch_path, small_side
from statledger.sources.bronze import land
from statledger.sources.tables import publish_table
from statledger.streaming import incremental


def digest(df):
    """Row count and two order-free checksums of the whole rows."""
    row = F.xxhash64(*sorted(df.columns))
    sums = df.agg(F.count("*"), F.bit_xor(row), F.sum(row.cast("decimal(38,0)")))
    return tuple(sums.first())


def arriving(spark, made, sf_dir):
    """An empty landing layer with its own tables, fed from the stand-in's."""
    fresh = Standin(spark, sf_dir, scratch_path(spark, "test"))
    target = made.warehouse(fresh.root)
    target.landing = fresh.landing
    return target, f"{fresh.root}/checkpoint"


def versions_upto(made, n):
    kept = [r[0] for r in RELEASES if r[3] <= n]
    return made.warehouse().bronze().filter(F.col("version").isin(kept))


def load(spark, target, checkpoint, publish):
    return incremental.run_incremental(
        spark, target.landing, checkpoint, SPEC.bronze_columns, publish(target)
    )


@pytest.mark.parametrize("publish", [incremental.rebuild, incremental.extend_or_rebuild])
def test_incremental_loads_equal_full_build(spark, made, sf_dir, publish):
    target, checkpoint = arriving(spark, made, sf_dir)
    land(versions_upto(made, 3), target.landing)
    assert load(spark, target, checkpoint, publish) == 1
    partial = target.fact().agg(F.max("valid_to_seq")).first()[0]
    assert partial == 3
    assert load(spark, target, checkpoint, publish) == 0
    rest = made.warehouse().bronze().filter(~F.col("version").isin(["1.0", "1.0.1", "1.0.2"]))
    land(rest, target.landing)
    assert load(spark, target, checkpoint, publish) == 1
    assert digest(target.fact()) == digest(made.tables.fact())
    assert digest(target.silver()) == digest(made.tables.silver())


def test_repeated_batch_is_not_loaded_twice(spark, made, sf_dir):
    target, _ = arriving(spark, made, sf_dir)
    land(versions_upto(made, 3), target.landing)
    batch = target.bronze()
    publish = incremental.extend_or_rebuild(target)
    publish(batch, "checkpoint#0")
    before = target._newest_run()
    publish(batch, "checkpoint#0")
    assert target._newest_run() == before == 0
    assert not target.extend(batch, "checkpoint#1")


def test_unpublished_run_stays_invisible(spark, made, sf_dir):
    target, _ = arriving(spark, made, sf_dir)
    land(versions_upto(made, 3), target.landing)
    target.build()
    before = digest(target.fact()), digest(target.silver())
    late = made.warehouse().bronze().filter("version = '2.0'")
    staged = target._stage_silver(to_silver(late, SPEC), 1)
    publish_table(staged, target.root, *SILVER, 1, full=False)
    assert (digest(target.fact()), digest(target.silver())) == before
    assert target.extend(late)
    whole = made.tables.silver().filter("dataset_version IN ('1.0','1.0.1','1.0.2','2.0')")
    assert digest(target.silver()) == digest(whole)


def test_two_loads_at_once_do_not_destroy_each_other(spark, made, sf_dir, monkeypatch):
    target, _ = arriving(spark, made, sf_dir)
    land(versions_upto(made, 2), target.landing)
    target.build()
    other = made.warehouse(target.root)
    third = made.warehouse().bronze().filter("version = '1.0.2'")
    fourth = made.warehouse().bronze().filter("version = '2.0'")
    publish, overtaken = Warehouse._publish, []

    def late(self, *args):
        if self is target and not overtaken:
            overtaken.append(True)
            assert other.extend(third, "third")
        return publish(self, *args)

    monkeypatch.setattr(Warehouse, "_publish", late)
    incremental.extend_or_rebuild(target)(fourth, "fourth")
    assert overtaken and target.is_loaded("third") and target.is_loaded("fourth")
    loaded = "dataset_version IN ('1.0','1.0.1','1.0.2','2.0')"
    assert digest(target.silver()) == digest(made.tables.silver().filter(loaded))
    assert target.fact().agg(F.max("valid_to_seq")).first()[0] == 4


def test_landing_a_version_again_changes_nothing(spark, made, sf_dir):
    target, checkpoint = arriving(spark, made, sf_dir)
    land(made.warehouse().bronze(), target.landing)
    load(spark, target, checkpoint, incremental.extend_or_rebuild)
    before = digest(target.fact())
    again = versions_upto(made, 1).drop("ingest_date")
    land(again, target.landing, ingest_date="2026-08-30")
    assert load(spark, target, checkpoint, incremental.extend_or_rebuild) == 1
    assert digest(target.fact()) == before


def test_late_extraction_of_old_version_supersedes_it(spark, made, sf_dir):
    target, checkpoint = arriving(spark, made, sf_dir)
    land(made.warehouse().bronze(), target.landing)
    load(spark, target, checkpoint, incremental.extend_or_rebuild)
    corrected = versions_upto(made, 1).drop("ingest_date").withColumn(
        "start_count", F.when(F.col("start_count") == "low", "low").otherwise("990")
    )
    land(corrected, target.landing, ingest_date="2026-08-30")
    load(spark, target, checkpoint, incremental.extend_or_rebuild)
    first = target.fact().filter("valid_from_seq = 1 AND start_count_status = 'published'")
    assert {r[0] for r in first.select("start_count").distinct().collect()} == {990}


def test_failed_load_is_tried_again(spark, made, sf_dir):
    target, checkpoint = arriving(spark, made, sf_dir)
    land(versions_upto(made, 1), target.landing)

    def failing(warehouse):
        def publish(batch, number):
            raise RuntimeError("no")

        return publish

    with pytest.raises(Exception, match="no"):
        load(spark, target, checkpoint, failing)
    assert load(spark, target, checkpoint, incremental.rebuild) == 1
    assert not target.fact().isEmpty()


def test_failed_check_stops_publication(spark, made, sf_dir):
    target, _ = arriving(spark, made, sf_dir)
    bad = versions_upto(made, 1).withColumn("start_count", F.lit("?"))
    land(bad, target.landing)
    with pytest.raises(quality.QualityGateError, match="values start_count_status"):
        target.build()
    with pytest.raises(FileNotFoundError):
        target.silver()


def test_state_advances_only_after_load(spark, made, tmp_path):
    state, versions, loaded = str(tmp_path / "state"), made.versions(), []

    def broken(version):
        raise RuntimeError("load failed")

    with pytest.raises(RuntimeError):
        incremental.load_if_new(versions, state, broken)
    assert incremental.last_seen(spark, state) is None
    assert incremental.load_if_new(versions, state, loaded.append) == "extract"
    assert incremental.load_if_new(versions, state, loaded.append) == "skip"
    assert loaded == ["2.0.2"] and incremental.last_seen(spark, state) == "2.0.2"


def test_scope_by_version_drops_keys_of_the_older_copy(spark, made):
    bronze = made.warehouse().bronze().filter("version = '2.0.2'")
    older = bronze.withColumn("ingest_date", F.lit("2026-08-01").cast("date"))
    newer = bronze.filter("region_code IS NULL")
    both = older.unionByName(newer)
    by_key, by_version = (to_silver(both, SPEC, scope=s) for s in ("key", "version"))
    assert by_key.count() == older.dropDuplicates(list(SPEC.natural_key)).count()
    assert by_version.filter("region_code IS NOT NULL").isEmpty()


def test_shuffles_grow_with_the_input_and_stay_bounded(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(10_000).write.parquet(path)
    assert session.shuffle_partitions(1 << 20, 8) == 8
    assert 8 < session.shuffle_partitions(10 << 30, 8) < session.MOST_PARTITIONS
    assert session.shuffle_partitions(100 << 40, 8) == session.MOST_PARTITIONS
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 4_000)
    with session.sized_shuffles(spark, path):
        assert int(spark.conf.get(session.INITIAL_PARTITIONS)) > 8
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None


def test_a_local_session_keeps_one_scratch_folder():
    def session_of(master):
        context = SimpleNamespace(master=master, applicationId=f"app {master}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context)

    local = session_of("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
    for master in ("local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(session_of(master))


def test_a_new_checkpoint_still_loads(spark, made, tmp_path):
    """Batch numbers begin anew with a checkpoint; what they hold must not be taken for loaded."""
    target = made.warehouse(str(tmp_path / "tables"))
    target.landing = str(tmp_path / "landing")
    checkpoint = tmp_path / "checkpoint"
    landed = made.warehouse().bronze()
    args = (spark, target.landing)
    for versions in (["1.0", "1.0.1"], ["1.0.2"]):
        land(landed.filter(F.col("version").isin(versions)), target.landing)
        batches = incremental.run_incremental(
            *args, f"{checkpoint}-{versions[0]}", SPEC.bronze_columns, incremental.rebuild(target)
        )
        assert batches == 1
    assert {r[0] for r in target.silver().select("dataset_version").distinct().collect()} == {
        "1.0", "1.0.1", "1.0.2",
    }


def test_small_side_is_bounded(spark):
    small, large = spark.range(5), spark.range(100)
    fact = spark.range(1000)

    def plan(side):
        joined = fact.join(small_side(side, max_rows=10).hint("none"), "id")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(small)
    assert "strategy=broadcast" not in plan(large)


def test_history_identities(made):
    fact, silver = made.tables.fact(), made.tables.silver()
    records, keys = fact.count(), fact.select("row_key").distinct().count()
    superseded = fact.filter("is_superseded").count()
    assert records == keys + superseded
    newest = silver.filter(F.col("dataset_version") == RELEASES[-1][0]).count()
    assert fact.filter("is_current").count() == newest
    withheld = fact.filter("start_count_status != 'published' AND start_count IS NOT NULL")
    assert withheld.isEmpty()


def test_spec_of_the_public_release_runs(spark, tmp_path):
    """The real column names go through the same code."""
    from statledger import EDUCATION_HEADLINE as spec

    level, *others = spec.dims
    cells = []
    for region, code in (("London", "E12000007"), (None, None)):
        for kind in ("Advanced Apprenticeship", "Higher Apprenticeship", "Total"):
            cells.append(
                ("202425", "Academic year", "National" if code is None else "Regional", "E92000001",
                 "England", code, region, kind, *(["Total"] * 4 if kind == "Total" else ["a"] * 4),
                 "200" if kind == "Total" else "100", "low", "z", "4.0", "c")
            )
    df = spark.createDataFrame(cells, ", ".join(f"{c} string" for c in spec.bronze_columns))
    land(df, str(tmp_path), "1.0", "2026-01-01")
    versions = spark.createDataFrame(
        [("1.0", "Major", None, 6, 1)],
        "version string, version_type string, published_at date, total_results bigint, version_seq bigint",
    )
    house = Warehouse(spark, str(tmp_path / "tables"), str(tmp_path), versions, spec)
    house.build()
    fact = house.fact()
    assert fact.count() == 6
    total = fact.filter("aggregation_depth = 5 AND geographic_level = 'National'").first()
    assert (total.start_count, total.academic_year_label) == (200, "2024/25")
