"""What a version changes in a type-2 history, without writing what stays.

A record that reaches the newest version is *open*: its ``valid_to_seq`` is NULL, so that a version which repeats it
needs no write. Only changed, new, returning and vanishing keys have rows here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGINS = ("valid_from_seq", "valid_from_version", "valid_from_published")
ENDS = ("valid_to_seq", "valid_to_version")


def record_columns(compare: Sequence[str], carry: Sequence[str]) -> tuple[str, ...]:
    """Columns of a stored record after its key."""
    return ("validity_group", *BEGINS, *ENDS, *carry, *compare)


def _same(a: str, b: str, names: Sequence[str]) -> Column:
    """Whether two structs agree in some fields, NULL being equal to NULL."""
    return reduce(and_, [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names], F.lit(True))


def advance_changes(
    last: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    seq: str,
    compare: Sequence[str],
    carry: Sequence[str],
    newest: tuple[int, str],
    version: str = "dataset_version",
    published: str = "published_at",
    break_on_gap: bool = False,
) -> DataFrame:
    """Records that a version newer than all before adds, closes or rewrites.

    ``last`` holds the last record of every key, ``new`` one row per key of that version, and ``newest`` the ordinal and
    label of the version before it. A key gets a row here if it is new, changed, vanished, or back after an
    absence, or if a carried column differs. ``is_superseded`` marks the record that a change closes. If both inputs are
    dealt by key alike, nothing is shuffled.
    """
    kept = (*carry, *compare)
    old_side = last.select(*key, F.struct(*record_columns(compare, carry)).alias("old"))
    new_side = new.select(*key, F.struct(seq, version, published, *kept).alias("new"))
    both = old_side.join(new_side, list(key), "full_outer")

    ended = F.coalesce("old.valid_to_seq", F.lit(newest[0]))
    is_open = F.col("old.valid_to_seq").isNull()
    known_end = [
        ended.alias("valid_to_seq"),
        F.when(is_open, F.lit(newest[1])).otherwise(F.col("old.valid_to_version")).alias("valid_to_version"),
    ]
    unknown_end = [
        F.lit(None).cast("bigint").alias("valid_to_seq"),
        F.lit(None).cast("string").alias("valid_to_version"),
    ]
    own_begin = [F.col(f"old.{c}").alias(c) for c in BEGINS]
    new_begin = [F.col(f"new.{c}").alias(n) for c, n in zip((seq, version, published), BEGINS, strict=True)]

    def fields(side: str) -> list[Column]:
        return [F.col(f"{side}.{c}").alias(c) for c in kept]

    def record(group: Column, begin, end, values, closes: bool = False) -> Column:
        return F.struct(
            group.cast("bigint").alias("validity_group"), *begin, *end, *values, F.lit(closes).alias("is_superseded")
        )

    group = F.col("old.validity_group")
    closed = record(group, own_begin, known_end, fields("old"), closes=True)
    frozen = record(group, own_begin, known_end, fields("old"))
    prolonged = record(group, own_begin, unknown_end, fields("new"))
    first, following = (record(g, new_begin, unknown_end, fields("new")) for g in (F.lit(1), group + 1))
    gap = F.lit(break_on_gap) & (F.col(f"new.{seq}") - ended > 1)
    nothing = F.filter(F.array(frozen), lambda r: F.lit(False))
    found = (
        F.when(F.col("old").isNull(), F.array(first))
        .when(F.col("new").isNull(), F.when(is_open, F.array(frozen)).otherwise(nothing))
        .when(
            _same("old", "new", compare) & ~gap,
            F.when(is_open & _same("old", "new", carry), nothing).otherwise(F.array(prolonged)),
        )
        .otherwise(F.array(closed, following))
    )
    return both.select(*key, F.inline(found))


def differing_keys(
    before: DataFrame, after: DataFrame, key: Sequence[str], compare: Sequence[str], carry: Sequence[str], published: str = "published_at"
) -> DataFrame:
    """Keys whose row of a version becomes another, with the new figures as ``new`` and whether there was a row before."""
    held = [*compare, *carry, published]
    old_side = before.select(*key, F.struct(*held).alias("old"))
    new_side = after.select(*key, F.struct(*held).alias("new"))
    differ = old_side.join(new_side, list(key), "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    return differ.select(*key, F.col("old").isNull().alias("was_lacking"), "new")


def touched_keys(
    differ: DataFrame, records: DataFrame, at: int, key: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Those of ``differ`` whose history changes with their row of version ``at``.

    A row that was lacking and falls inside a record with its figures changes nothing, as that record already spans
    the version.
    """
    spans = records.where((F.col("valid_from_seq") < at) & (F.lit(at) < F.col("valid_to_seq"))).select(
        *key, F.struct(*compare).alias("held")
    )
    lacking = differ.where("was_lacking")
    spanned = lacking.join(spans, list(key)).where(_same("held", "new", compare)).select(*key)
    return differ.select(*key).join(spanned, list(key), "left_anti")
