"""Fixed-size bitmaps of keys, to leave most rows out of a shuffle before an exact join."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Places of a bitmap of keys: 512 KiB.
KEY_BITS = 22


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A mark at the highest ``bits`` bits of every number in the only column of ``keys``.

    Marks are combined to words of 64 in Spark; at most ``2 ** (bits - 6)`` words are gathered.
    """
    place = F.shiftrightunsigned(keys.columns[0], 64 - bits)
    cells = keys.select(
        F.shiftright(place, 6).cast("int").alias("cell"),
        F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{keys.columns[0]}`, {64 - bits}) % 64 as int))").alias("word"),
    )
    found = cells.groupBy("cell").agg(F.bit_or("word").alias("word")).collect()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[[r["cell"] for r in found]] = np.array([r["word"] for r in found], np.int64).view(np.uint64)
    return words


def marked(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned keys have their mark."""
    place = keys >> np.uint64(64 - (len(words).bit_length() + 5))
    return (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def perhaps_in(rows: DataFrame, column: str, keys: DataFrame, present: bool = True) -> DataFrame:
    """Rows whose whole number in ``column`` is perhaps among the only column of ``keys``.

    None that is there is left out; a few others pass, so an exact join follows. Not ``present``
    gives exactly the other rows. The bitmap's words are broadcast to a join in Spark, so that no text is sent to Python.
    """

    def cell_and_bit(name: str) -> tuple[Column, Column]:
        place = F.shiftrightunsigned(F.xxhash64(F.col(f"`{name}`").cast("bigint")), 64 - KEY_BITS)
        return F.shiftright(place, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))

    cell, bit = cell_and_bit(keys.columns[0])
    words = keys.groupBy(cell.alias("__cell")).agg(F.bit_or(bit).alias("__word"))
    cell, bit = cell_and_bit(column)
    marked_there = (cell == F.col("__cell")) & (F.col("__word").bitwiseAND(bit) != 0)
    return rows.join(F.broadcast(words), marked_there, "left_semi" if present else "left_anti")


def without(rows: DataFrame, columns: str | Sequence[str], keys: DataFrame) -> DataFrame:
    """Rows whose ``columns`` are not among the rows of ``keys``; few of the others are shuffled.

    The first column is a whole number, by which the bitmap is made.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    key = keys.toDF(*[f"__key{k}" for k in range(len(columns))])
    near = perhaps_in(rows, columns[0], key.select("__key0"))
    kept = near.join(key, [near[c] == key[f"__key{k}"] for k, c in enumerate(columns)], "left_anti")
    return perhaps_in(rows, columns[0], key.select("__key0"), present=False).unionByName(kept)
