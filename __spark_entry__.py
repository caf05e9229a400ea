
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oracle_queries import ORACLE
from statledger.functions import academic_year
from statledger.operators import clusters, dims, history, lattice, marts, profile, quality
from statledger.operators.dedupe import latest_extraction
from statledger.operators.forecast import drift_forecast, fill_steps, holdout_check, order_forecast
from statledger.operators.silver import to_silver, with_version
from statledger.plans import lines as ln
from statledger.plans.ledger import Ledger
from statledger.plans.standin import LEVELS, RELEASES, SPEC, Standin, standin, table
from statledger.plans.totals import RunningTotals
from statledger.plans.warehouse import KEY, SEQ
from statledger.plans.warehouse import history as build_history
from statledger.session import scratch_path, written
from statledger.sources import bronze as br
from statledger.sources import catalogue as cat
from statledger.streaming.incremental import extend_or_rebuild, run_incremental

NEWEST = RELEASES[-1][0]
AS_OF_DAY = "2026-09-01"
SHARES = tuple(SPEC.mix_levels)
REVISION = ("restated_from_version", "restated_in_version")
SHAPE = ("abs_delta", "abs_pct_change", "disclosure_changed", "size_before")
HISTORY_LABELS = (
    "academic_year_label",
    SPEC.area_level,
    SPEC.area_name,
    SPEC.level,
    SPEC.dims[2],
    SPEC.dims[4],
)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def portable(df: DataFrame) -> DataFrame:
    """Dates as text, which every client of the comparison reads alike."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("string").alias(name) if kind == "date" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 9) for n in names})


# -- landed files and metadata ---------------------------------------------


def bronze_scan(spark, sf):
    return standin(spark, sf).warehouse().bronze()


def bronze_version_counts(spark, sf):
    return bronze_scan(spark, sf).groupBy("version", "ingest_date").agg(
        F.count("*").alias("row_count")
    )


def bronze_manifest(spark, sf):
    """Rows and content digest of every load; how many files hold it is up to the writer."""
    made = standin(spark, sf)
    loads = br.manifest(spark, made.landing, SPEC.bronze_columns, "standin")
    return loads.drop("ingested_at", "files", "bytes")


def bronze_files(spark, sf):
    """Loads put together from the records of their files."""
    files = br.file_manifest(spark, standin(spark, sf).landing, SPEC.bronze_columns)
    parts = F.split("digest", "-")
    sums = [F.sum(parts[k].cast("decimal(38,0)")).cast("string") for k in range(br.DIGEST_PARTS)]
    return files.groupBy(*br.PARTITIONS).agg(
        F.sum("row_count").alias("row_count"), F.concat_ws("-", *sums).alias("digest")
    )


def manifest_reconcile(spark, sf):
    made = standin(spark, sf)
    loads = br.manifest(spark, made.landing, SPEC.bronze_columns)
    return br.manifest_reconcile(loads, made.versions())


def dataset_versions(spark, sf):
    return standin(spark, sf).versions()


def version_history_json(spark, sf):
    pages = cat.version_pages(spark, standin(spark, sf).version_pages)
    return cat.version_history(cat.complete_pages(pages))


def version_listing(spark, sf):
    return cat.version_listing(version_history_json(spark, sf))


def query_pages(spark, sf):
    pages = cat.result_pages(spark, standin(spark, sf).result_pages, SPEC.bronze_columns)
    pages = cat.complete_pages(pages)
    regional = (F.col(SPEC.area_level) == SPEC.regional) & (F.col(SPEC.level) != SPEC.total)
    shown = (SPEC.period, SPEC.area_code, SPEC.level, SPEC.headline, SPEC.outcome)
    return cat.query_rows(pages, regional, shown)


def paging_check(spark, sf):
    """Problems of the result pages once some are lost and some landed twice."""
    pages = cat.result_pages(spark, standin(spark, sf).result_pages, SPEC.bronze_columns)
    number = F.col("paging.page")
    landed = pages.filter(number % 7 != 3)
    return cat.page_problems(landed.unionByName(landed.filter(number % 5 == 0)))


def lines_page_problems(spark, sf):
    """Orders as documents and their lines as pages: numbers that are missing or come again."""
    number = F.col("l_linenumber").cast("int")
    last = F.max(number).over(Window.partitionBy("l_orderkey"))
    pages = table(spark, sf, "lineitem").select(
        "l_orderkey", F.struct(number.alias("page"), last.alias("totalPages")).alias("paging")
    )
    return cat.page_problems(pages, ["l_orderkey"])


def metadata_labels(spark, sf):
    return cat.metadata_labels(cat.read_metadata(spark, standin(spark, sf).metadata))


def version_decision(spark, sf):
    """What a poll decides after each landed load, by the loads landed before it.

    The state is the version loaded last; rows say what the decision would load.
    """
    made = standin(spark, sf)
    landed = made.warehouse().bronze().groupBy("version", "ingest_date").agg(
        F.count("*").alias("row_count")
    )
    loads = landed.join(made.versions().select("version", SEQ), "version")
    in_order = Window.orderBy("ingest_date", SEQ)  # one row per load
    polled = loads.withColumn("previous_version", F.lag("version").over(in_order))
    action = cat.version_decision(F.col("version"), F.col("previous_version"))
    return polled.select(
        F.col("version").alias("latest_version"),
        "previous_version",
        action.alias("action"),
        F.when(action == cat.EXTRACT, F.col("row_count")).otherwise(0).alias("rows_to_load"),
    )


# -- typed rows ----------------------------------------------------------------


def silver_table(spark, sf):
    return standin(spark, sf).tables.silver()


def silver(spark, sf):
    return to_silver(bronze_scan(spark, sf), SPEC)


def typed_measures(spark, sf):
    names = [x for m in SPEC.measures for x in (m, f"{m}_status")]
    return silver_table(spark, sf).select("row_key", "dataset_version", *names)


def aggregation_depth(spark, sf):
    return silver_table(spark, sf).select(
        "row_key", "dataset_version", "aggregation_depth", "is_detail_grain"
    )


def academic_year_parse(spark, sf):
    start, end, label = academic_year("time_period")
    rows = bronze_scan(spark, sf).select(
        "time_period",
        start.alias("academic_year_start"),
        end.alias("academic_year_end"),
        label.alias("academic_year_label"),
    )
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("row_count"))


def natural_key(spark, sf):
    return (
        silver_table(spark, sf)
        .select("row_key", "academic_year_start", SPEC.area_level, SPEC.area_code, *SPEC.dims)
        .distinct()
    )


def latest_rows(spark, sf):
    keys = (SPEC.version, *SPEC.natural_key)
    return latest_extraction(bronze_scan(spark, sf), keys, (SPEC.ingested,))


def latest_extraction_query(spark, sf):
    kept = (SPEC.version, SPEC.ingested, *SPEC.natural_key, *SPEC.measures)
    return latest_rows(spark, sf).select(*kept)


# -- history -------------------------------------------------------------------


def fact_table(spark, sf):
    return standin(spark, sf).tables.fact()


def last_records(spark, sf):
    """Where the current records are; the superseded ones are not read."""
    return standin(spark, sf).tables.last_records()


def scd2_fact(spark, sf):
    made = standin(spark, sf)
    return build_history(made.tables.silver(), made.versions(), SPEC)


def scd2_break_on_gap(spark, sf):
    made = standin(spark, sf)
    return build_history(made.tables.silver(), made.versions(), SPEC, break_on_gap=True)


def scd2_extended(spark, sf):
    """History of all but the newest release, extended by the newest one."""
    made = standin(spark, sf)
    rows = with_version(made.tables.silver(), made.versions())
    before = made.versions().filter(F.col("version") != NEWEST)
    old = rows.filter(F.col("dataset_version") != NEWEST)
    fact = history.scd2(old, KEY, SEQ, SPEC.compared, SPEC.carried, versions=before)
    new = rows.filter(F.col("dataset_version") == NEWEST)
    return history.extend_history(fact, new, KEY, SEQ, SPEC.compared, SPEC.carried)


def incremental_load(spark, sf):
    """The history after two file-triggered loads: the first releases, then the rest."""
    made = standin(spark, sf)
    arriving = Standin(spark, sf, scratch_path(spark, "incremental"))
    target = made.warehouse(arriving.root)
    target.landing = arriving.landing
    checkpoint = f"{arriving.root}/checkpoint"
    landed = made.warehouse().bronze()
    first = [v for v, _, _, n, _ in RELEASES if n <= 4]
    for part in (F.col("version").isin(first), ~F.col("version").isin(first)):
        br.land(landed.filter(part), arriving.landing)
        run_incremental(
            spark, arriving.landing, checkpoint, SPEC.bronze_columns, extend_or_rebuild(target)
        )
    return target.fact()


def scd2_spliced(spark, sf):
    """The history of a ledger that got the newest release before an older one, which is spliced in."""
    made = standin(spark, sf)
    rows = with_version(made.tables.silver(), made.versions())
    return spliced_ledger(
        rows, KEY, SPEC.compared, SPEC.carried, late=4, newest=6, extracted="ingested_date"
    ).records()


def spliced_ledger(rows, key, compare, carry, late, newest, after_load=None, **options) -> Ledger:
    """A ledger loaded with all but two versions, then the newest one, then the late one."""
    kept = Ledger(
        rows.sparkSession, scratch_path(rows.sparkSession, "ledger"), key, SEQ, compare, carry, **options
    )
    first = ~F.col(SEQ).isin(late, newest)
    for part in (first, F.col(SEQ) == newest, F.col(SEQ) == late):
        kept.load(rows.filter(part))
        if after_load:
            after_load(kept)
    return kept


def moved_totals(rows, key, compare, carry, group, measures, **options):
    """Totals of a ledger's current records, refreshed after each of its three loads."""
    totals = []

    def refresh(kept):
        if not totals:
            totals.append(RunningTotals(kept, f"{kept.root}/totals", group, measures))
        totals[0].refresh()

    spliced_ledger(rows, key, compare, carry, after_load=refresh, **options)
    return totals[0].totals()


def running_totals(spark, sf):
    """Counts by year, region, segment and depth, moved by what each release changed."""
    made = standin(spark, sf)
    rows = with_version(made.tables.silver(), made.versions())
    group = ("academic_year_start", SPEC.area_level, SPEC.area_code, SPEC.level, "aggregation_depth")
    return moved_totals(
        rows, KEY, SPEC.compared, SPEC.carried, group, SPEC.counts, late=4, newest=6, extracted="ingested_date"
    )


def lines_running_totals(spark, sf):
    """Quantities by return flag and line status over the current lines, moved load by load."""
    rows = ln.typed(ln.latest(ln.register(spark, sf)))
    return moved_totals(
        rows, ln.KEY, ln.TYPED, ln.CARRY, ln.CARRY, ("quantity",), late=1995, newest=1998, version="version"
    )


def as_of_version(spark, sf):
    return history.as_of_version(fact_table(spark, sf), 3).select(
        "row_key", "valid_from_seq", "valid_to_seq", *SPEC.carried, *SPEC.compared
    )


def typed_vs_string_diff(spark, sf):
    made = standin(spark, sf)
    rows = with_version(to_silver(made.warehouse().bronze(), SPEC, text=True), made.versions())
    return history.text_and_typed_records(rows, KEY, SEQ, ["raw_fingerprint"], SPEC.compared)


def restatements(spark, sf):
    return history.restatement_history(
        fact_table(spark, sf), KEY, SPEC.headline, HISTORY_LABELS
    )


def version_deltas(spark, sf):
    made = standin(spark, sf)
    rows = with_version(to_silver(made.warehouse().bronze(), SPEC, text=True), made.versions())
    compare = {"restated": ["raw_fingerprint"], "restated_typed": SPEC.compared}
    return history.version_deltas(rows, KEY, SEQ, compare, made.versions())


# -- profiles --------------------------------------------------------------------


def double_count_proof(spark, sf):
    scope = bronze_scan(spark, sf).filter(
        (F.col("version") == NEWEST)
        & (F.col("time_period") == "200001")
        & (F.col(SPEC.area_level) == SPEC.national)
    )
    rows = latest_extraction(scope, SPEC.natural_key, (SPEC.ingested,))
    return profile.double_count_proof(rows, SPEC)


def depth_histogram(spark, sf):
    return profile.depth_histogram(silver_table(spark, sf), ["dataset_version"])


def marker_profile(spark, sf):
    return profile.marker_profile(
        silver_table(spark, sf), tuple(SPEC.measures), ["dataset_version"]
    )


def rounding_check(spark, sf):
    return profile.rounding_check(silver_table(spark, sf), SPEC.counts)


def reconciliation(spark, sf):
    return profile.reconcile(last_records(spark, sf), SPEC)


AREA_YEAR = ("academic_year_start", SPEC.area_level, SPEC.area_code)
# A withheld count has at most five lines behind it, of at most 50 pieces each.
STARTS = {"value": SPEC.headline, "status": SPEC.headline_status, "ceilings": {"suppressed_low": 250}}
PIECES = {"value": "pieces", "status": "pieces_status", "ceilings": ln.CUBE_CEILINGS}


def lattice_reconciliation(spark, sf):
    """Every published subtotal of the current records against its detail."""
    current = last_records(spark, sf).where("is_current")
    return lattice.reconcile_lattice(current, SPEC.dims, AREA_YEAR, **STARTS)


def withheld_bounds(spark, sf):
    """What subtraction tells about every withheld count of the current records."""
    current = last_records(spark, sf).where("is_current")
    return lattice.withheld_bounds(current, SPEC.dims, AREA_YEAR, **STARTS)


def disclosure_by_area(spark, sf):
    return lattice.disclosure_report(withheld_bounds(spark, sf), AREA_YEAR)


def lines_lattice(spark, sf):
    cells = ln.supplier_cube(spark, sf)
    return lattice.reconcile_lattice(cells, ln.CUBE_DIMS, ln.CUBE_BY, **PIECES)


def lines_withheld_bounds(spark, sf):
    cells = ln.supplier_cube(spark, sf)
    return lattice.withheld_bounds(cells, ln.CUBE_DIMS, ln.CUBE_BY, **PIECES)


# -- marts -----------------------------------------------------------------------


def regional_trends(spark, sf):
    return marts.regional_trends(last_records(spark, sf), SPEC)


def level_shift(spark, sf):
    return marts.level_shift(last_records(spark, sf), SPEC)


def pipeline_health(spark, sf):
    made = standin(spark, sf)
    house = made.tables
    return marts.pipeline_health(
        house.last_records(), house.silver(), made.versions(), SPEC, as_of=AS_OF_DAY
    )


def dim_academic_year(spark, sf):
    return dims.dim_academic_year(silver_table(spark, sf))


def dim_geography(spark, sf):
    return dims.dim_geography(silver_table(spark, sf), SPEC)


def dim_suppression_status(spark, sf):
    return dims.suppression_status_usage(silver_table(spark, sf), tuple(SPEC.measures))


def region_narrative_facts(spark, sf):
    return marts.region_narrative_facts(regional_trends(spark, sf), SPEC)


def region_prompts(spark, sf):
    return marts.region_prompts(region_narrative_facts(spark, sf), SPEC)


def region_mix_features(spark, sf):
    return marts.mix_features(last_records(spark, sf), SPEC)


def restatement_features(spark, sf):
    return marts.restatement_features(restatements(spark, sf), SPEC.headline)


def level_share_series(spark, sf):
    return marts.share_series(last_records(spark, sf), SPEC, LEVELS)


def feed_national_trend(spark, sf):
    return marts.feed_national_trend(last_records(spark, sf), SPEC)


def feed_level_mix(spark, sf):
    return marts.feed_level_mix(regional_trends(spark, sf), SPEC, LEVELS)


def feed_suppression(spark, sf):
    return marts.feed_suppression(regional_trends(spark, sf), SPEC)


def feed_revisions(spark, sf):
    return marts.feed_revisions(restatements(spark, sf))


# -- models ----------------------------------------------------------------------


def shares_forecast(spark, sf):
    return drift_forecast(
        level_share_series(spark, sf), "level", "academic_year_start", "share", horizon=4
    )


def forecast_query(spark, sf):
    return rounded(shares_forecast(spark, sf), "drift", "sigma", "forecast", "lower", "upper")


def forecast_holdout(spark, sf):
    actual = marts.share_series(last_records(spark, sf), SPEC, LEVELS, provisional=True)
    checked = holdout_check(
        shares_forecast(spark, sf), actual, "level", "academic_year_start", "share"
    )
    return rounded(checked, "forecast", "lower", "upper", "actual")


def supplier_forecast(spark, sf):
    """One series per supplier: quantity shipped each month to June 2001, four months on beside what came."""
    shipped = table(spark, sf, "lineitem").where("l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL")
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).cast("bigint")
    series = shipped.groupBy("l_suppkey", month.alias("month_no")).agg(
        F.sum("l_quantity").cast("bigint").alias("quantity")
    )
    last = 2001 * 12 + 5
    known = fill_steps(series.where(F.col("month_no") <= last), "l_suppkey", "month_no", "quantity", last)
    ahead = order_forecast(known, "l_suppkey", "month_no", "quantity")
    later = series.where(F.col("month_no") > last)
    checked = ahead.join(later, ["l_suppkey", "month_no"], "left").withColumn(
        "actual", F.coalesce("quantity", F.lit(0).cast("bigint"))
    )
    return checked.select(
        "l_suppkey",
        "month_no",
        "n",
        "p",
        "d",
        *[F.round(c, 6).alias(c) for c in ("sigma", "forecast", "lower", "upper")],
        "actual",
    )


def customer_forecast(spark, sf):
    """One series per customer: orders in each full year since the first, carried four years on.

    Years without orders count 0, and all series end with the last full year.
    """
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.year("o_orderdate").cast("bigint").alias("order_year")
    )
    full_years = orders.filter(~F.col("order_year").isin(*SPEC.provisional_years))
    series = full_years.groupBy("o_custkey", "order_year").agg(F.count("*").alias("placed"))
    filled = fill_steps(
        series, "o_custkey", "order_year", "placed", full_years.agg(F.max("order_year")).scalar()
    )
    ahead = drift_forecast(filled, "o_custkey", "order_year", "placed", drift_error=True)
    return rounded(ahead, "drift", "sigma", "forecast", "lower", "upper")


def region_segments(spark, sf):
    return clusters.kmeans_segments(region_mix_features(spark, sf), SHARES, k=3)


def restatement_shape(spark, sf):
    return clusters.kmeans_segments(restatement_features(spark, sf), SHAPE, k=4)


def restatement_anomalies(spark, sf):
    """The review queue: every revision by key, with its distance and flag."""
    return clusters.anomaly_flags(
        restatement_features(spark, sf), SHAPE, k=4, keep=(*KEY, *REVISION)
    )


def cluster_summary(scored: DataFrame, k: int, contamination: float = 0.02) -> DataFrame:
    """What holds of clustered rows whatever the seed: their number and two limits."""
    flagged = F.count_if("is_anomaly") if "is_anomaly" in scored.columns else F.lit(0)
    return scored.agg(
        F.count("*").alias("clustered_rows"),
        (F.max("segment") < k).alias("segments_within_k"),
        (flagged <= F.floor(F.count("*") * contamination)).alias("flags_within_share"),
    )


def region_segment_summary(spark, sf):
    return cluster_summary(region_segments(spark, sf), 3)


def restatement_shape_summary(spark, sf):
    return cluster_summary(restatement_shape(spark, sf), 4)


def restatement_anomaly_summary(spark, sf):
    return cluster_summary(restatement_anomalies(spark, sf), 4)


# -- checks ----------------------------------------------------------------------


def dq_silver_report(spark, sf):
    return quality.silver_report(silver_table(spark, sf), standin(spark, sf).versions(), SPEC)


def dq_fact_report(spark, sf):
    return quality.fact_report(fact_table(spark, sf), standin(spark, sf).versions(), SPEC)


def dq_not_null(spark, sf):
    """Rows without a region code, which are the national ones."""
    return quality.check_rows(latest_rows(spark, sf), quality.not_null(SPEC.area_code)).select(
        "version", *SPEC.natural_key
    )


def dq_unique(spark, sf):
    """Keys landed more than once for a version."""
    return quality.check_unique(bronze_scan(spark, sf), [*SPEC.natural_key, "version"])


def dq_accepted_values(spark, sf):
    rule = quality.not_in(f"{SPEC.activity}_status", ["published", "suppressed_low"])
    return quality.check_rows(silver_table(spark, sf), rule).select(
        "row_key", "dataset_version", f"{SPEC.activity}_status"
    )


def dq_range(spark, sf):
    rule = quality.outside("academic_year_start", 1995, 2000)
    return quality.check_rows(silver_table(spark, sf), rule).select(
        "row_key", "dataset_version", "academic_year_start"
    )


def dq_relationships(spark, sf):
    """Documents that no label refers to."""
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return quality.check_relationship(documents, "doc_id", table(spark, sf, "labels"), "doc_id")


def dq_current_matches_latest(spark, sf):
    return quality.check_current_count(last_records(spark, sf), standin(spark, sf).versions())


def dq_reconciliation(spark, sf):
    return quality.check_reconciliation(last_records(spark, sf), SPEC)


def dq_unrecognised(spark, sf):
    rule = quality.unrecognised((SPEC.headline, SPEC.outcome))
    return quality.check_rows(silver_table(spark, sf), rule).select("row_key", "dataset_version")


def dq_suppressed_has_value(spark, sf):
    rule = quality.valued_but_withheld(SPEC.headline)
    return quality.check_rows(fact_table(spark, sf), rule).select("row_key", "valid_from_seq")


def dq_version_lineage(spark, sf):
    return quality.version_lineage(fact_table(spark, sf))


def pii_columns(spark, sf):
    return quality.identifier_columns({t: table(spark, sf, t) for t in TABLES})


def identifier_summary(spark, sf):
    return quality.identifier_summary(pii_columns(spark, sf))


def pii_columns_whole_words(spark, sf):
    """Columns named by whole words; ``turn`` stands in for an identifier's name."""
    return quality.identifier_columns(
        {t: table(spark, sf, t) for t in TABLES}, "turn|urn", whole_words=True
    )


# -- the operators at row grain --------------------------------------------------


def lines_latest(spark, sf):
    return ln.latest(ln.register(spark, sf))


def lines_latest_by_version(spark, sf):
    return ln.latest(ln.register(spark, sf), scope="version")


def lines_measure_status(spark, sf):
    return profile.status_counts(ln.register(spark, sf), ln.MEASURES, ["version"])


def lines_scd2(spark, sf):
    return ln.full_history(spark, sf)


def lines_scd2_extended(spark, sf):
    register = ln.register(spark, sf)
    rows = written(ln.typed(ln.latest(register)), "lines")
    old = written(
        ln.line_history(rows.filter(F.col(SEQ) < 2000), register.filter(F.col(SEQ) < 2000)),
        "line-history",
    )
    return history.extend_history(
        old, rows.filter(F.col(SEQ) >= 2000), ln.KEY, SEQ, ln.TYPED, ln.CARRY, version="version"
    )


def lines_scd2_spliced(spark, sf):
    """The history of all lines by a ledger, 1995 loaded after 1998."""
    rows = ln.typed(ln.latest(ln.register(spark, sf)))
    return spliced_ledger(
        rows, ln.KEY, ln.TYPED, ln.CARRY, late=1995, newest=1998, version="version"
    ).records()


def lines_as_of(spark, sf):
    return history.as_of_version(ln.published_history(spark, sf), 1998).select(
        *ln.KEY, "valid_from_seq", "valid_to_seq", *ln.TYPED
    )


def lines_restatements(spark, sf):
    records = ln.revised_records(ln.published_history(spark, sf))
    return history.restatement_history(records, ln.KEY, "quantity")


def lines_revisions(spark, sf):
    return marts.feed_revisions(lines_restatements(spark, sf))


def lines_version_deltas(spark, sf):
    register = ln.register(spark, sf)
    rows = ln.typed(ln.latest(register), text=True)
    releases = register.select(SEQ, "version", F.lit("Annual").alias("version_type")).distinct()
    compare = {"restated": [f"{m}_text" for m in ln.MEASURES], "restated_typed": ln.TYPED}
    return history.version_deltas(rows, ln.KEY, SEQ, compare, releases)


def lines_typed_vs_string(spark, sf):
    rows = ln.typed(ln.latest(ln.register(spark, sf)), text=True)
    texts = [f"{m}_text" for m in ln.MEASURES]
    return history.text_and_typed_records(rows, ln.KEY, SEQ, texts, ln.TYPED)


def lines_duplicates(spark, sf):
    return quality.check_unique(table(spark, sf, "lineitem"), list(ln.KEY))


def lines_anomalies(spark, sf):
    shape = lines_restatement_features(spark, sf)
    return clusters.anomaly_flags(shape, SHAPE, k=4, keep=(*ln.KEY, *REVISION))


def lines_restatement_features(spark, sf):
    return marts.restatement_features(lines_restatements(spark, sf), "quantity", ln.KEY)


def lines_anomaly_summary(spark, sf):
    return cluster_summary(lines_anomalies(spark, sf), 4)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_scan": bronze_scan,
    "bronze_version_counts": bronze_version_counts,
    "bronze_manifest": bronze_manifest,
    "bronze_files": bronze_files,
    "manifest_reconcile": manifest_reconcile,
    "dataset_versions": dataset_versions,
    "version_history_json": version_history_json,
    "version_listing": version_listing,
    "query_pages": query_pages,
    "paging_check": paging_check,
    "lines_page_problems": lines_page_problems,
    "metadata_labels": metadata_labels,
    "version_decision": version_decision,
    "typed_measures": typed_measures,
    "aggregation_depth": aggregation_depth,
    "academic_year_parse": academic_year_parse,
    "natural_key": natural_key,
    "silver": silver,
    "latest_extraction": latest_extraction_query,
    "scd2_fact": scd2_fact,
    "scd2_break_on_gap": scd2_break_on_gap,
    "scd2_extended": scd2_extended,
    "scd2_spliced": scd2_spliced,
    "incremental_load": incremental_load,
    "as_of_version": as_of_version,
    "typed_vs_string_diff": typed_vs_string_diff,
    "restatement_history": restatements,
    "version_deltas": version_deltas,
    "double_count_proof": double_count_proof,
    "depth_histogram": depth_histogram,
    "marker_profile": marker_profile,
    "rounding_check": rounding_check,
    "reconciliation": reconciliation,
    "lattice_reconciliation": lattice_reconciliation,
    "withheld_bounds": withheld_bounds,
    "disclosure_by_area": disclosure_by_area,
    "lines_lattice": lines_lattice,
    "lines_withheld_bounds": lines_withheld_bounds,
    "regional_trends": regional_trends,
    "level_shift": level_shift,
    "pipeline_health": pipeline_health,
    "dim_academic_year": dim_academic_year,
    "dim_geography": dim_geography,
    "dim_suppression_status": dim_suppression_status,
    "region_narrative_facts": region_narrative_facts,
    "region_prompts": region_prompts,
    "region_mix_features": region_mix_features,
    "restatement_features": restatement_features,
    "level_share_series": level_share_series,
    "feed_national_trend": feed_national_trend,
    "feed_level_mix": feed_level_mix,
    "feed_suppression": feed_suppression,
    "feed_revisions": feed_revisions,
    "drift_forecast": forecast_query,
    "forecast_holdout": forecast_holdout,
    "customer_forecast": customer_forecast,
    "supplier_forecast": supplier_forecast,
    "region_segments": region_segments,
    "restatement_shape": restatement_shape,
    "restatement_anomalies": restatement_anomalies,
    "region_segment_summary": region_segment_summary,
    "restatement_shape_summary": restatement_shape_summary,
    "restatement_anomaly_summary": restatement_anomaly_summary,
    "dq_silver_report": dq_silver_report,
    "dq_fact_report": dq_fact_report,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_range": dq_range,
    "dq_relationships": dq_relationships,
    "dq_current_matches_latest": dq_current_matches_latest,
    "dq_reconciliation": dq_reconciliation,
    "dq_unrecognised": dq_unrecognised,
    "dq_suppressed_has_value": dq_suppressed_has_value,
    "dq_version_lineage": dq_version_lineage,
    "pii_columns": pii_columns,
    "pii_columns_whole_words": pii_columns_whole_words,
    "identifier_summary": identifier_summary,
    "lines_latest": lines_latest,
    "lines_latest_by_version": lines_latest_by_version,
    "lines_measure_status": lines_measure_status,
    "lines_scd2": lines_scd2,
    "lines_scd2_extended": lines_scd2_extended,
    "running_totals": running_totals,
    "lines_running_totals": lines_running_totals,
    "lines_scd2_spliced": lines_scd2_spliced,
    "lines_as_of": lines_as_of,
    "lines_restatements": lines_restatements,
    "lines_revisions": lines_revisions,
    "lines_version_deltas": lines_version_deltas,
    "lines_typed_vs_string": lines_typed_vs_string,
    "lines_duplicates": lines_duplicates,
    "lines_anomalies": lines_anomalies,
    "lines_restatement_features": lines_restatement_features,
    "lines_anomaly_summary": lines_anomaly_summary,
}


def _registered(query: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(query(spark, sf_dir))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """How far a naive sum overstates the published total."""
    return queries()["double_count_proof"](spark, "/root/testdata/sf0.001")


def _text_modules() -> list:
    """Modules with queries over text, where that subpackage is present."""
    try:
        import corpus_pipeline
        from statledger.llm import queries as text_queries
    except ImportError:
        return []
    return [text_queries, corpus_pipeline]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    for module in _text_modules():
        found |= module.queries()
    return {name: _registered(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLE)
    for module in _text_modules():
        found |= module.oracle_sql()
    return found
