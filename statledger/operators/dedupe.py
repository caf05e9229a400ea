"""Resolve an append-only landing table to its latest extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statledger.session import small_side


def latest_extraction(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scope: str = "key",
    tiebreak: Sequence[str] | None = None,
    load: str = "version",
    hashed: bool = True,
) -> DataFrame:
    """Newest copy of each key, or of each load.

    ``scope="key"`` keeps the newest row per key, so a key that a later
    extraction of the same load dropped survives. ``scope="version"`` keeps the
    newest extraction of each ``load`` as a whole, and such a key goes.

    Ranking on 1 lets Spark cut every group to one row per task before the
    shuffle (``WindowGroupLimit``), so a key copied very often stays cheap.
    Ties on ``order`` fall to ``tiebreak``, by default all other columns.
    Without ``hashed`` rows come out sorted by ``keys``, which a window over the first of them then need not do.
    """
    if scope not in ("key", "version"):
        raise ValueError(f"scope must be 'key' or 'version', not {scope!r}")
    if scope == "version":
        newest = df.groupBy(load).agg(*[F.max(F.struct(*order)).alias("_newest")])
        newest = newest.select(load, *[F.col(f"_newest.{c}").alias(c) for c in order])
        df = df.join(small_side(newest), [load, *order], "left_semi")
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in (*keys, *order)]
    # Sorting compares the hash first, a number, and the key's text only on ties.
    first = [F.xxhash64(*keys)] if hashed else []
    ranked = Window.partitionBy(*first, *keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in (*order, *tiebreak)]
    )
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
