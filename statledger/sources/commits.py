"""Numbered entries that only one writer can add, and bucketed tables kept by path.

An entry is written aside and renamed to its number. The rename fails where that number exists, as it does for Spark's
own streaming logs, so of two loads that started from the same state one is published and the other is told.
On a store whose rename is not atomic, loads must not run side by side.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class ConcurrentLoad(RuntimeError):
    """Another load was published since this one read the state."""


def _path(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = made.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(made)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, path = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def add_entry(spark: SparkSession, folder: str, name: str, entry: dict) -> bool:
    """Add an entry unless one of that name exists; returns whether it was added."""
    system, target = _path(spark, f"{folder}/{name}")
    aside = _path(spark, f"{folder}/_aside/{uuid.uuid4().hex}")[1]
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(entry), "utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(aside, target, options)
    except Py4JJavaError as failed:
        system.delete(aside, False)
        if "FileAlreadyExistsException" in failed.java_exception.getClass().getName():
            return False
        raise
    return True


def read_entry(spark: SparkSession, folder: str, name: str) -> dict:
    """One entry; it is a single line."""
    return json.loads(spark.read.text(f"{folder}/{name}").first()[0])


def _table_name(folder: str) -> str:
    return f"by_key_{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex}"


def add_bucketed(df: DataFrame, folder: str, key: Sequence[str], buckets: int, into: str | None = None) -> None:
    """Add rows, dealt to buckets by key, to the folder; with ``into`` to the subfolder that this column names.

    They are written aside and their files moved, so writers of one folder do not meet. Readers see
    files as they come, and tell by a column of theirs which rows were published.
    """
    spark, aside = df.sparkSession, f"{folder}/_aside/{uuid.uuid4().hex}"
    name = _table_name(aside)
    writer = df.repartition(buckets, *key).write.format("parquet").bucketBy(buckets, *key).sortBy(*key)
    if into:
        writer = writer.partitionBy(into)
    writer.option("path", aside).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    parts = [(f"{aside}/{n}", f"{folder}/{n.split('=')[1]}") for n in list_names(spark, aside) if "=" in n]
    for source, target in parts if into else [(aside, folder)]:
        system, made = _path(spark, target)
        system.mkdirs(made)
        for n in list_names(spark, source):
            if n.startswith("part-"):
                system.rename(_path(spark, f"{source}/{n}")[1], _path(spark, f"{target}/{n}")[1])
    system, left = _path(spark, aside)
    system.delete(left, True)


def read_bucketed(
    spark: SparkSession, folder: str, schema: T.StructType, key: Sequence[str], buckets: int
) -> DataFrame:
    """Rows added by ``add_bucketed``, which one join or window by key reads without a shuffle.

    Buckets are no property of files that a plain read would find, so the folder gets an entry in the session's catalog.
    """
    name, columns = _table_name(folder), ", ".join(f"`{k}`" for k in key)
    system, path = _path(spark, folder)
    system.mkdirs(path)
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({columns}) "
            f"SORTED BY ({columns}) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
    spark.catalog.refreshTable(name)
    return spark.table(name)
