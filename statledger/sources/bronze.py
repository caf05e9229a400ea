"""The landing layer: releases as published, every column text.

Layout below a base folder::

    data/version=<X>/ingest_date=<Y>/*.csv
    _meta/version=<X>/ingest_date=<Y>/*.json
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA = "data"
META = "_meta"
PARTITIONS = ("version", "ingest_date")

# A landed file with quoted line breaks is read by one task, so files stay small.
ROWS_PER_FILE = 1_000_000

MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# The 32 hex digits of a row's MD5, cut into so many numbers.
DIGEST_PARTS = 4
MANIFEST_SCHEMA = (
    "dataset_id string, dataset_version string, ingest_date date, ingested_at timestamp, "
    "row_count bigint, files bigint, bytes bigint, digest string"
)

CSV = {"header": True, "quote": '"', "escape": '"'}


def bronze_schema(columns: Sequence[str]) -> T.StructType:
    """Text columns, plus the partition columns with their types.

    Left to inference, versions ``1.0`` and ``2.0`` would become numbers.
    """
    fields = [T.StructField(c, T.StringType()) for c in columns]
    fields += [
        T.StructField("version", T.StringType()),
        T.StructField("ingest_date", T.DateType()),
    ]
    return T.StructType(fields)


def read_bronze(
    spark: SparkSession, base: str, columns: Sequence[str], quoted_newlines: bool = True
) -> DataFrame:
    """All landed extractions. Filters on ``version`` and ``ingest_date`` prune folders.

    Without ``quoted_newlines`` Spark splits large files; use it for files
    whose cells hold no line breaks.
    """
    return (
        spark.read.schema(bronze_schema(columns))
        .options(**CSV, multiLine=quoted_newlines)
        .csv(f"{base}/{DATA}")
    )


def utc_today() -> date:
    return datetime.now(timezone.utc).date()


def land(
    df: DataFrame,
    base: str,
    version: str | None = None,
    ingest_date: date | str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Add an extraction; landing the same version again on one day replaces that copy.

    ``df`` may bring its own ``version`` and ``ingest_date`` columns. The
    rebalance hint groups rows by partition folder and lets Spark split a
    version that holds most of the rows over several tasks.
    """
    if version is not None:
        df = df.withColumn("version", F.lit(version))
    if "ingest_date" not in df.columns or ingest_date is not None:
        df = df.withColumn("ingest_date", F.lit(ingest_date or utc_today()).cast("date"))
    (
        df.hint("rebalance", *PARTITIONS)
        .write.partitionBy(*PARTITIONS)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .options(**CSV)
        .csv(f"{base}/{DATA}")
    )


def land_files(
    spark: SparkSession,
    source: str,
    base: str,
    columns: Sequence[str],
    version: str,
    ingest_date: date | str | None = None,
    quoted_newlines: bool = True,
) -> None:
    """Land downloaded CSV files of one version unchanged, every column as text.

    Without ``quoted_newlines`` Spark splits large files over tasks.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    files = spark.read.schema(schema).options(**CSV, multiLine=quoted_newlines).csv(source)
    land(files, base, version, ingest_date)


def metadata_path(base: str, version: str, ingest_date: date | str) -> str:
    """Where a load's metadata goes: apart from the data, so that scans never meet it."""
    return f"{base}/{META}/version={version}/ingest_date={ingest_date}"


def store_metadata(
    document: DataFrame, base: str, version: str, ingest_date: date | str | None = None
) -> str:
    """Store a load's one-row metadata document beside it; returns the folder."""
    path = metadata_path(base, version, ingest_date or utc_today())
    document.coalesce(1).write.mode("overwrite").json(path)
    return path


def row_digest(columns: Sequence[str]) -> list[Column]:
    """A row's MD5 as four numbers that may be added up; NULL differs from any text.

    Every cell goes in with its length, so a value that moves to the next column changes the digest.
    Sums keep repeated rows apart, which combining by exclusive or would cancel.
    """
    cells = []
    for name in columns:
        cell = F.col(f"`{name}`").cast("string")
        marked = F.concat(F.length(cell).cast("string"), F.lit(":"), cell)
        cells.append(F.coalesce(marked, F.lit("-")))
    hashed = F.md5(F.concat(*cells))
    return [
        F.conv(F.substring(hashed, 8 * k + 1, 8), 16, 10).cast("decimal(38,0)").alias(f"_digest{k}")
        for k in range(DIGEST_PARTS)
    ]


def _digest_sums() -> list[Column]:
    return [F.sum(f"_digest{k}").alias(f"_digest{k}") for k in range(DIGEST_PARTS)]


def _digest() -> Column:
    parts = [
        F.coalesce(F.col(f"_digest{k}"), F.lit(0)).cast("decimal(38,0)").cast("string")
        for k in range(DIGEST_PARTS)
    ]
    return F.concat_ws("-", *parts).alias("digest")


def _counted_files(
    spark: SparkSession, base: str, columns: Sequence[str], load: Column | None
) -> DataFrame:
    """Every landed file with its size, rows and digest sums, from one scan of its load."""
    scanned, listed = read_bronze(spark, base, columns), _listed_files(spark, base)
    if load is not None:
        scanned, listed = scanned.filter(load), listed.filter(load)
    rows = (
        scanned.select(F.col("_metadata.file_path").alias("path"), *row_digest(columns))
        .groupBy("path")
        .agg(F.count("*").alias("row_count"), *_digest_sums())
    )
    # A file with a header and nothing else has no rows to count.
    return listed.join(rows, "path", "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0).cast("bigint"))
    )


def _listed_files(spark: SparkSession, base: str) -> DataFrame:
    """Landed files and their sizes by the listing; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(f"{base}/{DATA}")
    )
    return files.select(
        F.col("version").cast("string"),
        F.col("ingest_date").cast("date"),
        F.col("_metadata.file_path").alias("path"),
        F.col("length").alias("bytes"),
    )


def file_manifest(spark: SparkSession, base: str, columns: Sequence[str]) -> DataFrame:
    """Size, rows and content digest of every landed file, whatever its size."""
    return _counted_files(spark, base, columns, None).select(
        *PARTITIONS, "path", "bytes", "row_count", _digest()
    )


def manifest(
    spark: SparkSession,
    base: str,
    columns: Sequence[str],
    dataset_id: str = "",
    load: Column | None = None,
) -> DataFrame:
    """One row per landed extraction: rows, files, bytes and a digest of the content.

    ``load`` is a condition on version and ingest_date, which prunes folders. The digest is
    the sum over all rows, so neither order nor the cut into files matters, while every row counts.
    """
    files = _counted_files(spark, base, columns, load)
    summed = files.groupBy(*PARTITIONS).agg(
        F.sum("row_count").alias("row_count"),
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        *_digest_sums(),
    )
    return summed.select(
        F.lit(dataset_id).alias("dataset_id"),
        F.col("version").alias("dataset_version"),
        "ingest_date",
        F.current_timestamp().alias("ingested_at"),
        "row_count",
        "files",
        "bytes",
        _digest(),
    )


def record_load(
    spark: SparkSession,
    base: str,
    columns: Sequence[str],
    version: str,
    ingest_date: date | str | None = None,
    dataset_id: str = "",
) -> DataFrame:
    """Add the manifest record of one load beside the data, and return it as stored.

    Only that load is read. Records are never rewritten: a version landed again
    on one day gets a second record with its own time.
    """
    day = F.lit(ingest_date or utc_today()).cast("date")
    load = (F.col("version") == version) & (F.col("ingest_date") == day)
    record = manifest(spark, base, columns, dataset_id, load)
    stored = spark.createDataFrame(record.collect(), record.schema).coalesce(1)  # one row
    writer = stored.write.mode("append").option("timestampFormat", MICROSECONDS)
    writer.json(f"{base}/{META}/manifest")
    return stored


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """The stored record of every load, the newest where a load was repeated."""
    by_load = Window.partitionBy("dataset_version", "ingest_date").orderBy(F.desc("ingested_at"))
    records = spark.read.schema(MANIFEST_SCHEMA).json(f"{base}/{META}/manifest")
    return records.withColumn("_n", F.row_number().over(by_load)).filter("_n = 1").drop("_n")


def manifest_reconcile(counted: DataFrame, versions: DataFrame) -> DataFrame:
    """Extractions beside the total their publisher declared, with the difference."""
    declared = versions.select(F.col("version").alias("dataset_version"), "total_results")
    return counted.join(declared, "dataset_version", "left").select(
        "dataset_version",
        "ingest_date",
        "row_count",
        "total_results",
        F.col("row_count").eqNullSafe(F.col("total_results")).alias("matches"),
    )
