"""Load whatever landed since the last run.

The streaming checkpoint is the memory of what was loaded. It advances only
after ``publish`` returns, so a failed load is tried again. ``publish`` then gets
the same label and must be repeatable.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statledger.plans.warehouse import Warehouse
from statledger.sources.bronze import CSV, DATA, bronze_schema
from statledger.sources.catalogue import EXTRACT, decide
from statledger.sources.commits import ConcurrentLoad

# How often a load starts again because others were published first.
ATTEMPTS = 5

Publish = Callable[[DataFrame, str], None]


def run_incremental(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    columns: Sequence[str],
    publish: Publish,
    files_per_batch: int | None = None,
    quoted_newlines: bool = True,
) -> int:
    """Hand all files landed since the last run to ``publish``; returns the batches run."""
    reader = spark.readStream.schema(bronze_schema(columns)).options(
        **CSV, multiLine=quoted_newlines
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    batches = 0

    def counted(batch: DataFrame, number: int) -> None:
        nonlocal batches
        # The id is stored in the checkpoint: a new checkpoint is a new query, whose batches are new.
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the streaming query's id is unknown, so repeated batches could not be told")
        publish(batch, f"{query_id}#{number}")
        batches += 1

    query = (
        reader.csv(f"{landing}/{DATA}")
        .writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return batches


def _until_published(warehouse: Warehouse, label: str, load: Callable[[], None]) -> None:
    """Run a load, from the new state if another one was published in between."""
    for attempt in range(ATTEMPTS):
        if warehouse.is_loaded(label):
            return
        try:
            return load()
        except ConcurrentLoad:
            if attempt == ATTEMPTS - 1:
                raise


def rebuild(warehouse: Warehouse) -> Publish:
    """Rebuild from the whole landing layer, so the order of arrival does not matter."""

    def publish(batch: DataFrame, label: str) -> None:
        _until_published(warehouse, label, lambda: warehouse.build(label))

    return publish


def extend_or_rebuild(warehouse: Warehouse) -> Publish:
    """Extend the history by newer versions; rebuild when an older one landed again."""

    def publish(batch: DataFrame, label: str) -> None:
        _until_published(warehouse, label, lambda: warehouse.extend(batch, label) or warehouse.build(label))

    return publish


STATE_SCHEMA = (
    "dataset_id string, action string, latest_version string, previous_version string, "
    "decided_at timestamp"
)


def last_seen(spark: SparkSession, state: str) -> str | None:
    """The version loaded last according to the state folder, None before the first."""
    try:
        log = spark.read.schema(STATE_SCHEMA).json(f"{state}/last_seen")
    except AnalysisException:
        return None
    return log.agg(F.max_by("latest_version", "decided_at")).first()[0]


def load_if_new(
    versions: DataFrame, state: str, load: Callable[[str], None], dataset_id: str = ""
) -> str:
    """Load the newest listed version unless it was loaded last; returns the action.

    Every decision is recorded. The last-seen version advances only after
    ``load`` returned, so a failed load is tried again.
    """
    spark = versions.sparkSession
    decision = decide(versions, last_seen(spark, state), dataset_id).first()
    record = spark.createDataFrame([decision], STATE_SCHEMA).coalesce(1)
    record.write.mode("append").json(f"{state}/decisions")
    if decision.action == EXTRACT:
        load(decision.latest_version)
        record.write.mode("append").json(f"{state}/last_seen")
    return decision.action
