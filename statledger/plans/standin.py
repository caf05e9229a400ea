"""A published table made from the star schema, with all the defects real ones have.

Order lines are counted per year, area and five dimensions, cubed with ``Total``
members, rounded to 10, masked where few lines are behind a figure, and released
in six versions that add, remove, restate and reformat cells.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statledger.functions import natural_key, per_mille
from statledger.plans.warehouse import Warehouse
from statledger.session import scratch_path, sized_shuffles, written
from statledger.sources.bronze import land, store_metadata
from statledger.sources.catalogue import read_versions, seed_rows
from statledger.spec import TableSpec

SPEC = TableSpec(
    dims=("market_segment", "return_flag", "line_status", "priority_band", "order_status"),
    level="market_segment",
    residual_area="MIDDLE EAST",
    unknown_level="MACHINERY",
    provisional_years=(2001,),
    year_range=(1995, 2001),
    mix_levels={
        "share_automobile": "AUTOMOBILE",
        "share_building": "BUILDING",
        "share_furniture": "FURNITURE",
    },
    narrative_years=(1995, 2000),
)
LEVELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
PROVISIONAL_YEAR = 2001
LOW_LINES = 6

# version, type, published_at, version_seq, day of extraction
RELEASES = (
    ("1.0", "Major", "2025-07-25", 1, "2026-08-20"),
    ("1.0.1", "Patch", "2025-10-08", 2, "2026-08-20"),
    ("1.0.2", "Patch", "2025-11-27", 3, "2026-08-20"),
    ("2.0", "Major", "2026-01-29", 4, "2026-08-20"),
    ("2.0.1", "Patch", "2026-03-26", 5, "2026-08-20"),
    ("2.0.2", "Patch", "2026-07-16", 6, "2026-08-24"),
)
# The last version was extracted before, incompletely and with other figures.
EARLIER_DAY = "2026-08-22"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def finest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and quantities at the finest grain, at most a few thousand rows.

    Aggregating here keeps the cube off the order lines. The two large joins
    are on keys; Spark splits a hot order or customer over several tasks.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment"
    )
    areas = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_regionkey", "r_name")
    )
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        areas, F.col("c_nationkey") == F.col("n_nationkey")
    )
    quantity = F.col("l_quantity").cast("bigint")
    achieved = F.col("l_discount") < 0.05
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.year("o_orderdate").alias("year"),
            F.concat(F.lit("R"), "r_regionkey").alias("region_code"),
            F.col("r_name").alias("region_name"),
            F.col("c_mktsegment").alias("market_segment"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
            F.when(urgent, "High").otherwise("Normal").alias("priority_band"),
            F.col("o_orderstatus").alias("order_status"),
        )
        .agg(
            F.count("*").alias("lines"),
            F.sum(quantity).alias("starts"),
            F.count_if(achieved).alias("achieved_lines"),
            F.coalesce(F.sum(F.when(achieved, quantity)), F.lit(0)).alias("achievements"),
        )
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All published cells: each area level crossed with every subtotal."""
    dims = SPEC.dims
    area = ("region_code", "region_name")
    sets = [
        ["year", *place, *kept]
        for place in ((), area)
        for n in range(len(dims) + 1)
        for kept in combinations(dims, n)
    ]
    counts = ("lines", "starts", "achieved_lines", "achievements")
    # Stored, since subtotals and wholes are both made of them, and two plans would each join all lines again.
    finest = written(finest_cells(spark, sf_dir), "finest-cells")
    # A few thousand rows would end up in one task, which then makes every subtotal.
    spread = finest.repartition(spark.sparkContext.defaultParallelism)
    cubed = (
        spread
        .groupingSets(sets, "year", *area, *dims)
        .agg(
            *[F.sum(c).alias(c) for c in counts],
            *[F.grouping(d).alias(f"_{d}") for d in dims],
        )
    )
    depth = sum([F.col(f"_{d}") for d in dims[1:]], F.col(f"_{dims[0]}"))
    rows = cubed.select(
        "year",
        F.concat(
            F.col("year").cast("string"), F.lpad(((F.col("year") + 1) % 100).cast("string"), 2, "0")
        ).alias("time_period"),
        F.lit("Calendar year").alias("time_identifier"),
        F.when(F.col("region_code").isNull(), "National").otherwise("Regional").alias(
            "geographic_level"
        ),
        F.lit("W1").alias("country_code"),
        F.lit("World").alias("country_name"),
        *area,
        *[F.coalesce(d, F.lit(SPEC.total)).alias(d) for d in dims],
        *counts,
        depth.alias("depth"),
    )
    whole = rows.filter(F.col("depth") == len(dims)).select(
        F.col("time_period").alias("_period"),
        F.col("region_code").alias("_region"),
        F.col("starts").alias("all_starts"),
        F.col("achievements").alias("all_achievements"),
    )
    keyed = natural_key(("year", *SPEC.natural_key[1:]), {"region_code": SPEC.null_area})
    return rows.join(
        whole,
        (F.col("time_period") == F.col("_period"))
        & F.col("region_code").eqNullSafe(F.col("_region")),
    ).select(*rows.columns, "all_starts", "all_achievements", F.substring(keyed, 1, 2).alias("h"))


def _rounded(value: Column) -> Column:
    return F.floor((value + 5) / 10).cast("bigint") * 10


def _percent(part: Column, whole: Column, decimals: Column) -> Column:
    tenths = per_mille(part, whole)
    units, tenth = F.floor(tenths / 10).cast("bigint"), tenths % 10
    text = F.concat(units.cast("string"), F.lit("."), tenth.cast("string"))
    return F.when(~decimals & (tenth == 0), units.cast("string")).otherwise(text)


def releases(published: DataFrame) -> DataFrame:
    """Every extraction of every version of the given cells, as text.

    ``h``, the first two hex digits of the key's hash, decides which cells a
    version touches. A change stays in later versions unless undone.
    """
    h, year, seq = F.col("h"), F.col("year"), F.col("version_seq")

    def within(low: str, high: str) -> Column:
        return (h >= low) & (h < high)

    final = year < PROVISIONAL_YEAR
    regional = F.col("geographic_level") == SPEC.regional
    removed = regional & (h >= "f8")
    paused = regional & within("f0", "f2")
    present = (
        F.when(seq <= 2, final & (h >= "20"))
        .when(seq == 3, final & ~within("10", "20") & ~removed)
        .when(seq == 5, ~removed & ~paused)
        .otherwise(~removed)
    )

    newly_shown = (seq >= 5) & within("40", "80")
    low = (F.col("lines") < LOW_LINES) & ~(newly_shown & (F.col("lines") == LOW_LINES - 1))
    low_achieved = F.col("achieved_lines") < LOW_LINES
    restated = F.when((seq >= 3) & within("a0", "b0"), 10).otherwise(0)
    restated = restated + F.when(
        (seq >= 6) & within("80", "90") & (year == PROVISIONAL_YEAR), 10
    ).otherwise(0)
    stale = F.when(~F.col("complete") & within("c0", "c8"), 20).otherwise(0)
    decimals = seq >= 4
    starts = _rounded(F.col("starts")) + restated + stale

    extractions = F.array(
        *[
            F.struct(
                F.lit(v).alias("version"),
                F.lit(n).cast("bigint").alias("version_seq"),
                F.lit(day).cast("date").alias("ingest_date"),
                F.lit(complete).alias("complete"),
            )
            for v, n, day, complete in [
                *[(v, n, day, True) for v, _, _, n, day in RELEASES],
                (RELEASES[-1][0], RELEASES[-1][3], EARLIER_DAY, False),
            ]
        ]
    )
    rows = published.select("*", F.inline(extractions)).filter(
        present & (F.col("complete") | (h >= "10"))
    )
    return rows.select(
        "time_period",
        "time_identifier",
        "geographic_level",
        "country_code",
        "country_name",
        "region_code",
        "region_name",
        *SPEC.dims,
        F.when(low, "low").otherwise(starts.cast("string")).alias("start_count"),
        F.when(low_achieved, "low")
        .otherwise(_rounded(F.col("achievements")).cast("string"))
        .alias("achievement_count"),
        F.when(F.col("depth") < 3, "z")
        .when((seq >= 3) & within("d0", "d4"), F.lit(None))
        .when(F.col("lines") < LOW_LINES, "low")
        .otherwise(_rounded(F.col("lines")).cast("string"))
        .alias("participation_count"),
        F.when(low, "c")
        .otherwise(_percent(F.col("starts"), F.col("all_starts"), decimals))
        .alias("starts_percent"),
        F.when(low_achieved, "c")
        .otherwise(_percent(F.col("achievements"), F.col("all_achievements"), decimals))
        .alias("achievements_percent"),
        "version",
        "ingest_date",
        "complete",
    )


def declared_versions(spark: SparkSession, extracted: DataFrame) -> DataFrame:
    """The version seed, with the row totals of the complete extractions."""
    released = seed_rows(
        spark,
        [
            {
                "version": v,
                "version_type": kind,
                "published_at": date.fromisoformat(day),
                "total_results": None,
                "version_seq": n,
            }
            for v, kind, day, n, _ in RELEASES
        ],
    ).drop("total_results")
    totals = extracted.groupBy("version").agg(
        F.count_if("complete").alias("total_results")
    )
    return released.join(totals, "version").select(
        "version", "version_type", "published_at", "total_results", "version_seq"
    )


class Standin:
    """The landed stand-in and what is derived from it, each written once per session."""

    # Rounding alone may exceed the tolerance in a part year; reported, not blocking.
    ALLOWED = ("detail reconciles to published total",)

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None):
        self.spark = spark
        self.root = root or scratch_path(spark, "standin")
        self.sf_dir = sf_dir
        self.landing = f"{self.root}/landing"
        self.seed = f"{self.root}/seed/versions"

    def land(self) -> None:
        """Write the cells, every extraction of them, and the version seed."""
        path = f"{self.root}/cells"
        inputs = [table(self.spark, self.sf_dir, name) for name in ("lineitem", "orders")]
        with sized_shuffles(self.spark, tables=inputs):
            cells(self.spark, self.sf_dir).write.mode("overwrite").parquet(path)
        extracted = releases(self.spark.read.parquet(path))
        land(extracted.drop("complete"), self.landing)
        declared_versions(self.spark, extracted).coalesce(1).write.mode("overwrite").option(
            "header", True
        ).csv(self.seed)

    @cached_property
    def tables(self) -> Warehouse:
        """The derived tables, built when first asked for."""
        house = self.warehouse()
        house.build()
        return house

    @cached_property
    def version_pages(self) -> str:
        """Folder of version-listing pages, one JSON document per file."""
        path = f"{self.root}/version_pages"
        periods = (
            self.tables.silver()
            .groupBy(F.col("dataset_version").alias("version"))
            .agg(
                F.min("academic_year_label").alias("start"),
                F.max("academic_year_label").alias("end"),
            )
        )
        # The metadata-only patch lists neither status nor periods.
        full = F.col("version") != "1.0.1"
        listed = self.versions().join(periods, "version")
        entry = F.struct(
            "version",
            F.col("version_type").alias("type"),
            F.when(full, "Published").alias("status"),
            F.concat(F.col("published_at").cast("string"), F.lit("T09:30:00Z")).alias("published"),
            F.col("total_results").alias("totalResults"),
            F.when(full, F.struct("start", "end")).alias("timePeriods"),
        )
        (
            listed.groupBy(F.ceil(F.col("version_seq") / 4).cast("int").alias("page"))
            .agg(F.collect_list(entry).alias("results"))
            .withColumn("paging", F.struct("page", F.lit(2).alias("totalPages")))
            .write.mode("overwrite")
            .partitionBy("page")
            .json(path)
        )
        return path

    @cached_property
    def result_pages(self) -> str:
        """Folder of query-result pages, one JSON document per line.

        A page holds the cells of one period, area and segment, at most as many
        as the other dimensions have combinations.
        """
        path = f"{self.root}/result_pages"
        newest = self.warehouse().bronze().filter(
            (F.col("version") == RELEASES[-1][0]) & (F.col("ingest_date") == RELEASES[-1][4])
        )
        group = ("time_period", "geographic_level", "region_code", SPEC.level)
        pages = newest.groupBy(*group).agg(F.collect_list(F.struct(*SPEC.bronze_columns)).alias("results"))
        numbers = newest.select(*group).distinct()
        total = numbers.count()
        number = F.row_number().over(Window.orderBy(*group))  # one row per page, without its cells
        paging = F.struct(number.alias("page"), F.lit(total).alias("totalPages")).alias("paging")
        same = [F.col(f"p.{c}").eqNullSafe(F.col(f"n.{c}")) for c in group]
        (
            pages.alias("p")
            .join(numbers.select(*group, paging).alias("n"), same)
            .select("p.results", "n.paging")
            .write.mode("overwrite")
            .json(path)
        )
        return path

    @cached_property
    def metadata(self) -> str:
        """Folder of the metadata document stored beside the newest load."""
        silver = self.tables.silver().filter(F.col("dataset_version") == RELEASES[-1][0])

        def option(column: str, **names: str) -> Column:
            return F.sort_array(
                F.collect_set(F.struct(*[F.col(c).alias(n) for n, c in names.items()]))
            ).alias(column)

        sets = silver.agg(
            *[option(d, id=d, label=d) for d in SPEC.dims],
            F.sort_array(
                F.collect_set(
                    F.when(
                        F.col("region_code").isNotNull(),
                        F.struct(
                            F.col("region_code").alias("code"), F.col("region_name").alias("label")
                        ),
                    )
                )
            ).alias("places"),
            option("periods", period="academic_year_start", label="academic_year_label"),
        )

        def entry(name: str, options: Column) -> Column:
            return F.struct(
                F.lit(name).alias("id"),
                F.lit(name.replace("_", " ").capitalize()).alias("label"),
                options.alias("options"),
            )

        document = sets.select(
            F.array(*[entry(d, F.col(d)) for d in SPEC.dims]).alias("filters"),
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("id"),
                        F.lit(m.replace("_", " ").capitalize()).alias("label"),
                        F.lit("").alias("unit"),
                    )
                    for m in SPEC.measures
                ]
            ).alias("indicators"),
            F.array(
                F.struct(F.lit(SPEC.regional).alias("level"), F.col("places").alias("options"))
            ).alias("locations"),
            F.transform(
                "periods",
                lambda p: F.struct(
                    F.lit("CY").alias("code"),
                    p["period"].cast("string").alias("period"),
                    p["label"].alias("label"),
                ),
            ).alias("timePeriods"),
        )
        return store_metadata(document, self.landing, RELEASES[-1][0], RELEASES[-1][4])

    def versions(self) -> DataFrame:
        return read_versions(self.spark, self.seed)

    def warehouse(self, root: str | None = None) -> Warehouse:
        return Warehouse(
            self.spark, root or self.root, self.landing, self.versions(), SPEC, self.ALLOWED
        )


_READY: dict[tuple[str, str], Standin] = {}


def standin(spark: SparkSession, sf_dir: str) -> Standin:
    """The stand-in over ``sf_dir``, landed the first time it is asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _READY:
        made = Standin(spark, sf_dir)
        made.land()
        _READY[key] = made
    return _READY[key]
