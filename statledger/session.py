"""Where a job may write, and which small tables it may broadcast."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes one shuffle partition should hold, and how much larger rows are than their files.
SHUFFLE_BYTES = 128 << 20
UNPACKED = 4
# Bytes a value takes in a shuffled row, about: 8 for a number, more for a short text.
VALUE_BYTES = 16
MOST_PARTITIONS = 20_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_FOLDERS: dict[str, str] = {}

# Rows a join side may have to be broadcast.
BROADCAST_ROWS = 10_000


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a session in one process without that setting gets a temporary folder, one for its lifetime.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _FOLDERS:
        _FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="statledger-")
    return _FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/statledger/{purpose}-{uuid.uuid4().hex}"


def shuffle_partitions(total_bytes: int, least: int) -> int:
    """Shuffle partitions for an input of so many bytes, from ``least`` to ``MOST_PARTITIONS``.

    Beyond that bound partitions grow with the input instead: the driver keeps an
    entry for every pair of a map task and a partition.
    """
    wanted = math.ceil(total_bytes * UNPACKED / SHUFFLE_BYTES)
    return max(least, min(wanted, MOST_PARTITIONS))


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below the paths, by listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return sum(files.load(path).agg(F.sum("length")).first()[0] or 0 for path in paths)


def row_partitions(least: int, *tables: DataFrame) -> int:
    """Shuffle partitions for all rows of the tables, from ``least`` to ``MOST_PARTITIONS``.

    Files of few distinct values may be any number of times smaller than their rows, which are what a
    task sorts. Of stored tables only the footers are read.
    """
    size = sum(t.count() * len(t.columns) * VALUE_BYTES for t in tables)
    return max(least, min(math.ceil(size / SHUFFLE_BYTES), MOST_PARTITIONS))


@contextmanager
def sized_shuffles(spark: SparkSession, *paths: str, tables: Sequence[DataFrame] = ()):
    """Jobs run inside start their shuffles with enough partitions for the files below ``paths`` and rows of ``tables``.

    Adaptive execution merges small shuffle partitions but does not make more of
    them, so their first number has to follow the input. Afterwards the
    setting is as before, so that later small jobs don't pay for it.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    least = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = row_partitions(shuffle_partitions(stored_bytes(spark, *paths), least), *tables)
    spark.conf.set(INITIAL_PARTITIONS, wanted)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else unchanged.

    The rows read for the check, never more than ``max_rows + 1``, are the rows
    that get broadcast, so the input is not computed twice. A larger input
    goes through the ordinary shuffled join.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` stored in the shared folder, for results that several jobs read.

    Unlike a cached result it does not have to be computed again when an
    executor is lost.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
