"""Plan shapes the operators promise."""

import re

from pyspark.sql import functions as F

from statledger.operators import history, marts
from statledger.operators.dedupe import latest_extraction
from statledger.plans import lines as ln
from statledger.plans.standin import SPEC
from statledger.plans.warehouse import history as build_history


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_history_needs_one_shuffle_and_one_sort(made):
    text = plan(build_history(made.tables.silver(), made.versions(), SPEC))
    assert len(exchanges(text)) == 1 and exchanges(text)[0].startswith("row_key")
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert "Aggregate(keys=[row_key" not in text


def test_restatements_reuse_the_history_shuffle(spark, sf_dir):
    told = history.restatement_history(ln.full_history(spark, sf_dir), ln.KEY, "quantity")
    assert len(exchanges(plan(told))) == 1


def test_dedupe_limits_groups_before_the_shuffle(spark, sf_dir):
    lines = ln.register(spark, sf_dir)
    text = plan(latest_extraction(lines, ["version", *ln.KEY], ["ingest_date"]))
    before, after = text.index("Final"), text.index("Partial")
    assert "WindowGroupLimit" in text and before < text.index("Exchange") < after


def test_marts_read_few_columns_and_push_filters(made):
    text = plan(marts.regional_trends(made.tables.fact(), SPEC))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "row_key" not in read and "order_status" not in read
    assert "EqualTo(is_current,true)" in text and "EqualTo(geographic_level,Regional)" in text


def test_year_filter_prunes_partitions(made):
    text = plan(made.tables.fact().filter(F.col("academic_year_start") == 2000))
    assert re.search(r"PartitionFilters: \[[^\]]*academic_year_start[^\]]* = 2000", text)


def test_current_records_skip_the_superseded_folders(made):
    house = made.tables
    rows = house.last_records()
    files = {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}
    assert files and all("is_superseded=false" in f for f in files)
    assert re.search(r"PartitionFilters: \[[^\]]*is_superseded", plan(rows))


def test_deltas_need_no_join_of_the_rows(spark, sf_dir):
    lines = ln.register(spark, sf_dir)
    rows = ln.typed(ln.latest(lines), text=True)
    releases = lines.select("version_seq", "version", F.lit("a").alias("version_type")).distinct()
    text = plan(
        history.version_deltas(rows, ln.KEY, "version_seq", {"restated": ln.TYPED}, releases)
    )
    assert "FullOuter" not in text and "CartesianProduct" not in text
    assert len([e for e in exchanges(text) if e.startswith("l_orderkey")]) == 1


def test_no_python_workers_in_any_plan(spark, sf_dir):
    import __spark_entry__ as entry

    for name in ("scd2_fact", "silver", "regional_trends", "lines_scd2", "drift_forecast"):
        text = plan(entry.queries()[name](spark, sf_dir))
        assert "Python" not in text and "Pandas" not in text, name


def test_line_history_sorts_once(spark, sf_dir):
    text = plan(ln.full_history(spark, sf_dir))
    assert len(exchanges(text)) == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_partitions_follow_rows(spark, monkeypatch):
    from statledger import session

    same = spark.range(4000).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 1000)
    assert session.row_partitions(8, same) == 4000 * 2 * session.VALUE_BYTES // 1000
    assert session.row_partitions(8, same.limit(3)) == 8
    with session.sized_shuffles(spark, tables=[same, same]):
        assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == 256
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None


def test_cells_join_the_lines_once(spark, sf_dir):
    from statledger.plans.standin import cells

    assert "lineitem.parquet" not in plan(cells(spark, sf_dir))
