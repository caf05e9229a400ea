"""Column expressions and small steps that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.session import written

SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a name for ``value``, so that ``value`` is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other letter stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(ws: Column, width: int = 5) -> Column:
    """Hashes of ``width`` consecutive words at every place, repeats included.

    Fewer words count as one shingle; no words give an empty array.
    """
    wide = F.slice(
        F.transform(
            ws, lambda w, i: F.xxhash64(w, *[F.get(ws, i + F.lit(j)) for j in range(1, width)])
        ),
        1,
        F.greatest(F.size(ws) - F.lit(width - 1), F.lit(0)),
    )
    whole = F.array(F.xxhash64(F.array_join(ws, " ")))
    return F.when(F.size(ws) >= width, wide).when(F.size(ws) > 0, whole).otherwise(
        F.array().cast("array<bigint>")
    )


def with_row(df: DataFrame, *columns: str) -> DataFrame:
    """Some columns of a table and a number that tells equal rows apart.

    The number depends on how the scan is split, and so on the executors there are. What is to be joined by it
    is stored first, as by ``stored_rows``, and never numbered again.
    """
    return df.select(*columns, F.monotonically_increasing_id().alias("row"))


def fresh_name(df: DataFrame, base: str = "row") -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def with_text_keys(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with two columns that tell a text wherever it is read again, and their names.

    The first is a whole number for bitmaps, the second a SHA-256 digest, by which equal texts are equal.
    """
    names = [fresh_name(docs, "text_key"), fresh_name(docs, "digest")]
    keys = [F.xxhash64("text"), F.unhex(F.sha2(F.col("text"), 256))]
    return docs.withColumns(dict(zip(names, keys, strict=True))), names


def stored_rows(docs: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``docs`` stored with a number of its own for every row, and the name of that column."""
    row = fresh_name(docs)
    return written(docs.withColumn(row, F.monotonically_increasing_id()), purpose), row
