"""Order lines as a published register: the operators at row grain.

Lines repeat per order and line number; each ship year acts as a release, each
ship day as an extraction, and the figures are masked text. Unlike a cube of
fixed size, this register grows with the data, and so do its history and its
revisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statledger.functions import measure_status, measure_value
from statledger.operators.dedupe import latest_extraction
from statledger.operators.history import scd2
from statledger.session import row_partitions, sized_shuffles, written

KEY = ("l_orderkey", "l_linenumber")
MEASURES = {"quantity": "bigint", "discount_percent": "double", "tax_percent": "double"}
TYPED = (*MEASURES, *[f"{m}_status" for m in MEASURES])
CARRY = ("l_returnflag", "l_linestatus")
SEQ = "version_seq"
# The figures published per supplier: their dimensions, and how few lines, of at most 50 pieces each, are withheld.
CUBE_BY = ("l_suppkey",)
CUBE_DIMS = ("l_returnflag", "l_linestatus", "discount_band")
FEW_LINES = 6
CUBE_CEILINGS = {"suppressed_low": 50 * (FEW_LINES - 1)}
REFORMATTED_SINCE = 1998


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with release, extraction day and masked text measures."""
    path = f"{sf_dir}/lineitem.parquet"
    lines = spark.read.parquet(path)
    year = F.year("l_shipdate")
    low = F.col("l_quantity") < 6
    discount = F.round(F.col("l_discount") * 100).cast("bigint").cast("string")
    tax = F.round(F.col("l_tax") * 100).cast("bigint").cast("string")
    return lines.select(
        *KEY,
        year.cast("string").alias("version"),
        year.cast("bigint").alias(SEQ),
        F.make_date(year, F.lit(12), F.lit(31)).alias("published_at"),
        F.to_date("l_shipdate").alias("ingest_date"),
        *CARRY,
        F.when(low, "low")
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
        .alias("quantity"),
        F.when(low, "c")
        .when(year >= REFORMATTED_SINCE, F.concat(discount, F.lit(".0")))
        .otherwise(discount)
        .alias("discount_percent"),
        F.when(F.col("l_tax") == 0, "z").otherwise(tax).alias("tax_percent"),
    )


def latest(lines: DataFrame, scope: str = "key", dealt: bool = False) -> DataFrame:
    """One row per key and ship year; of rows ``dealt`` by key they come out in the order of a history."""
    return latest_extraction(
        lines,
        keys=(*KEY, SEQ) if dealt else ("version", *KEY),
        order=("ingest_date",),
        scope=scope,
        tiebreak=(*MEASURES, *CARRY),
        hashed=not dealt,
    )


def typed(lines: DataFrame, text: bool = False) -> DataFrame:
    """Measures as values and statuses; ``text`` keeps the cells as published too."""
    return lines.select(
        *KEY,
        "version",
        SEQ,
        "published_at",
        *CARRY,
        *[measure_value(m, t).alias(m) for m, t in MEASURES.items()],
        *[measure_status(m).alias(f"{m}_status") for m in MEASURES],
        *([F.col(m).alias(f"{m}_text") for m in MEASURES] if text else []),
    )


def line_history(rows: DataFrame, releases: DataFrame, **options) -> DataFrame:
    """Type-2 history of typed lines; ``releases`` holds the release ordinals."""
    return scd2(
        rows, KEY, SEQ, TYPED, CARRY, version="version", versions=releases.select(SEQ), **options
    )


def full_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of all lines, with one shuffle and one sort of full rows.

    Rows are dealt by the history's key before the dedupe; the windows of both steps
    find their keys together, and in the same order. Lines are copied a few times at most, so nothing is lost by not
    cutting copies before the shuffle.
    """
    lines = register(spark, sf_dir)
    return line_history(typed(latest(lines.repartition(*KEY), dealt=True)), lines)


def supplier_cube(spark: SparkSession, sf_dir: str, total: str = "Total") -> DataFrame:
    """Pieces per supplier and three dimensions with all subtotals, rounded to 10, few lines withheld.

    Lines are added up at the finest grain first, so that the subtotals are made of cells.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    discount = F.round(F.col("l_discount") * 100).cast("bigint").cast("string")
    fine = (
        lines.withColumn("discount_band", discount)
        .select(*CUBE_BY, *[F.coalesce(d, F.lit("unknown")).alias(d) for d in CUBE_DIMS], "l_quantity")
        .groupBy(*CUBE_BY, *CUBE_DIMS)
        .agg(F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("pieces"))
    )
    kept = [[d for k, d in enumerate(CUBE_DIMS) if not up >> k & 1] for up in range(1 << len(CUBE_DIMS))]
    sets = [[F.col(c) for c in (*CUBE_BY, *dims)] for dims in kept]
    cells = fine.groupingSets(sets, *CUBE_BY, *CUBE_DIMS).agg(
        F.sum("lines").alias("lines"), F.sum("pieces").alias("pieces")
    )
    low = F.col("lines") < FEW_LINES
    return cells.select(
        *CUBE_BY,
        *[F.coalesce(d, F.lit(total)).alias(d) for d in CUBE_DIMS],
        F.when(~low, F.expr("(pieces + 5) DIV 10 * 10")).alias("pieces"),
        F.when(low, "suppressed_low").otherwise("published").alias("pieces_status"),
    )


_PUBLISHED: dict[tuple[str, str], DataFrame] = {}


def published_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``full_history`` as stored once per session, for the reports that read it."""
    made = (spark.sparkContext.applicationId, sf_dir)
    if made not in _PUBLISHED:
        with sized_shuffles(spark, tables=[register(spark, sf_dir)]):
            _PUBLISHED[made] = written(full_history(spark, sf_dir), "line-history")
    return _PUBLISHED[made]


def revised_records(published: DataFrame) -> DataFrame:
    """Records of the keys that have several, dealt by key: the only ones a restatement is made of.

    Dealt to as many tasks as the published records need, since a window alone would not make more for more rows.
    """
    least = published.sparkSession.sparkContext.defaultParallelism
    several = published.filter("is_superseded OR validity_group > 1")
    return several.repartition(row_partitions(least, published), *KEY)
