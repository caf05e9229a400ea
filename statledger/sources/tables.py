"""Derived tables by layer, published run by run.

A run is written below ``<root>/<layer>/<table>/run=<id>`` and becomes visible
when a line naming it is appended to the table's publication log. A failed
check leaves the earlier run in place, a lost executor leaves nothing half
visible, and no two loads get the same folder. A line that names the run it follows can be added
only once, so of two loads that began with the same state one is published and the other is told.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.sources.commits import ConcurrentLoad, add_entry

LAYERS = ("bronze", "silver", "gold")
LOG_SCHEMA = (
    "run bigint, is_full boolean, label string, newest_seq bigint, table_schema string, "
    "published_at timestamp"
)
ROWS_PER_FILE = 5_000_000


def table_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root}/{layer}/{table}"


def _log_path(root: str, layer: str, table: str) -> str:
    return f"{root}/publications/{layer}/{table}"


def claim_run(spark: SparkSession, root: str, layer: str, table: str, least: int) -> int:
    """A run number from ``least`` up that no other load has or gets."""
    run = least
    while not add_entry(spark, f"{root}/claims/{layer}/{table}", str(run), {}):
        run += 1
    return run


def stage_table(
    df: DataFrame,
    root: str,
    layer: str,
    table: str,
    run: int,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Write a run of a table, partitioned and sorted for pruning; returns it as stored.

    Rebalancing keeps files of even size: many rows of one partition value are
    split over tasks, few are not scattered over many small files.
    """
    path = f"{table_path(root, layer, table)}/run={run}"
    out = df.hint("rebalance", *partition_by)
    if partition_by or cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_table(
    stored: DataFrame,
    root: str,
    layer: str,
    table: str,
    run: int,
    full: bool = True,
    label: str = "",
    newest_seq: int | None = None,
    after: int | None = None,
) -> None:
    """Make a staged run visible: in place of all earlier ones, or added to them.

    With ``after``, the run that the load began with, or -1, it fails if another run was published after that one.

    ``label`` says what was loaded, so that a repeated load can be recognised, and
    ``newest_seq`` up to which version, so that the next load need not look for it in the data.
    """
    entry = {
        "run": run,
        "is_full": full,
        "label": label,
        "newest_seq": newest_seq,
        "table_schema": stored.schema.json(),
        "published_at": datetime.now(timezone.utc).isoformat(),
    }
    name = f"run={run}-{uuid.uuid4().hex}" if after is None else f"after={after}"
    if not add_entry(stored.sparkSession, _log_path(root, layer, table), name, entry):
        raise ConcurrentLoad(f"{layer}.{table}: {name} is published already")


def publications(spark: SparkSession, root: str, layer: str, table: str) -> list[Row]:
    """The publication log, newest run first; of a run published again only the last entry."""
    try:
        log = spark.read.schema(LOG_SCHEMA).json(_log_path(root, layer, table))
    except AnalysisException:
        return []
    entries = log.orderBy(F.desc("run"), F.desc("published_at")).collect()  # one per publication
    newest = {}
    for entry in entries:
        newest.setdefault(entry.run, entry)
    return list(newest.values())


def read_table(
    spark: SparkSession,
    root: str,
    layer: str,
    table: str,
    runs: Sequence[int] | None = None,
) -> DataFrame:
    """A published table with its stored column types.

    Reads the newest full run and those added since; ``runs`` leaves out all others.
    """
    log = publications(spark, root, layer, table)
    entries = [e for e in log if runs is None or e.run in runs]
    return read_runs(spark, root, layer, table, entries).drop("run")


def read_runs(
    spark: SparkSession, root: str, layer: str, table: str, entries: Sequence[Row]
) -> DataFrame:
    """The runs that make up a table by its log, with the run number to prune on."""
    if not entries:
        raise FileNotFoundError(f"{layer}.{table} has no published run")
    runs = []
    for entry in entries:
        runs.append(entry.run)
        if entry.is_full:
            break
    schema = T.StructType.fromJson(json.loads(entries[0].table_schema))
    base = table_path(root, layer, table)
    stored = spark.read.schema(schema).option("basePath", base)
    rows = stored.parquet(*[f"{base}/run={run}" for run in sorted(runs)])
    return rows.select(*schema.fieldNames(), "run")
