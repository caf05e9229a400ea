"""Type-2 history over published versions, and the reports built on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statledger.functions import safe_divide

def _differs(cols: Sequence[str], window) -> Column:
    """Any column distinct from its value on the previous row (NULL equals NULL)."""
    return reduce(or_, [~F.lag(c).over(window).eqNullSafe(F.col(c)) for c in cols])


def _collapse(
    rows: DataFrame, key: Sequence[str], seq: str, compare: Sequence[str], break_on_gap: bool
) -> DataFrame:
    """Keep the last row of every unchanged run, with the run's beginning.

    ``_from`` holds the version a row's run began in and ``_group`` the number
    of records its key had by then; both matter when a row is already a record.
    Both window steps share one shuffle and one sort on the key; there is no
    aggregation, and a key has at most one row per version.
    """
    by_key = Window.partitionBy(*key).orderBy(seq)
    first = F.lag(seq).over(by_key).isNull()
    opens = first | _differs(compare, by_key)
    if break_on_gap:
        opens = opens | (F.col("_begins") - F.lag(seq).over(by_key) > 1)
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(F.col("_opens"), F.col("_group")).otherwise(0)
    return (
        rows.withColumn("_begins", F.col("_from.seq"))
        .withColumn("_opens", opens)
        .withColumns(
            {
                "_next": F.lead("_opens").over(by_key),
                "_run": F.last(F.when(F.col("_opens"), F.col("_from")), True).over(so_far),
                "validity_group": F.sum(step).over(so_far).cast("bigint"),
            }
        )
        .filter(F.coalesce("_next", F.lit(True)))
    )


def _release_rows(
    df: DataFrame, key: Sequence[str], seq: str, version: str, published: str, kept: Sequence[str]
) -> DataFrame:
    """Rows of a release, each a record of its own so far."""
    return df.select(
        *key,
        seq,
        version,
        F.struct(
            F.col(seq).alias("seq"),
            F.col(version).alias("version"),
            F.col(published).alias("published"),
        ).alias("_from"),
        F.lit(1).cast("bigint").alias("_group"),
        *kept,
    )


def _records(
    runs: DataFrame,
    key: Sequence[str],
    seq: str,
    version: str,
    kept: Sequence[str],
) -> DataFrame:
    return runs.select(
        *key,
        "validity_group",
        F.col("_run.seq").alias("valid_from_seq"),
        F.col(seq).alias("valid_to_seq"),
        F.col("_run.version").alias("valid_from_version"),
        F.col(version).alias("valid_to_version"),
        F.col("_run.published").alias("valid_from_published"),
        *kept,
        F.col("_next").isNotNull().alias("is_superseded"),
    )


def _flagged(records: DataFrame, latest: Column) -> DataFrame:
    """Current means alive in the newest version; the rest is kept but never current."""
    return records.select(
        *[c for c in records.columns if c != "is_superseded"],
        (F.col("valid_to_seq") == latest).alias("is_current"),
        (F.col("valid_to_seq") < latest).alias("is_soft_deleted"),
        "is_superseded",
    )


def scd2(
    df: DataFrame,
    key: Sequence[str],
    seq: str,
    compare: Sequence[str],
    carry: Sequence[str] = (),
    version: str = "dataset_version",
    published: str = "published_at",
    versions: DataFrame | None = None,
    break_on_gap: bool = False,
) -> DataFrame:
    """Collapse one row per key and version into validity records.

    A record covers consecutive versions whose ``compare`` columns are equal,
    NULL counting as equal to NULL. Pass typed columns with their statuses, so
    that ``4`` and ``4.0`` are one figure. ``carry`` columns come from the
    record's newest version.

    A key that is absent from some versions and returns unchanged stays one
    record; ``break_on_gap`` opens a new one. ``is_soft_deleted`` holds for every
    record that does not reach the newest version; ``is_superseded`` tells those
    followed by another record of the key from those whose key disappeared.

    Rows must be unique per key and version (see ``latest_extraction``), which
    bounds a window group by the number of versions.
    """
    newest = (versions if versions is not None else df).agg(F.max(seq)).scalar()
    kept = [*carry, *compare]
    rows = _release_rows(df, key, seq, version, published, kept)
    runs = _collapse(rows, key, seq, compare, break_on_gap)
    return _flagged(_records(runs, key, seq, version, kept), newest)


def advance_history(
    last: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    seq: str,
    compare: Sequence[str],
    carry: Sequence[str] = (),
    version: str = "dataset_version",
    published: str = "published_at",
    break_on_gap: bool = False,
) -> DataFrame:
    """What becomes of each key's last record when versions newer than all before arrive.

    ``last`` holds the records that are not superseded. Each is prolonged or
    followed by new records; the result holds it and those. The flags of
    records superseded before do not change any more.
    """
    kept = [*carry, *compare]
    newest = new.agg(F.max(seq)).scalar()
    held = last.select(
        *key,
        F.col("valid_to_seq").alias(seq),
        F.col("valid_to_version").alias(version),
        F.struct(
            F.col("valid_from_seq").alias("seq"),
            F.col("valid_from_version").alias("version"),
            F.col("valid_from_published").alias("published"),
        ).alias("_from"),
        F.col("validity_group").alias("_group"),
        *kept,
    )
    rows = held.unionByName(_release_rows(new, key, seq, version, published, kept))
    runs = _collapse(rows, key, seq, compare, break_on_gap)
    return _flagged(_records(runs, key, seq, version, kept), newest)


def extend_history(
    fact: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    seq: str,
    compare: Sequence[str],
    carry: Sequence[str] = (),
    **options,
) -> DataFrame:
    """History after versions newer than all in ``fact``, without the old silver rows.

    Superseded records pass through without a shuffle. Equals ``scd2`` over all
    versions.
    """
    last = fact.filter("NOT is_superseded")
    records = advance_history(last, new, key, seq, compare, carry, **options)
    return fact.filter("is_superseded").select(*records.columns).unionByName(records)


def as_of_version(fact: DataFrame, seq: int | Column) -> DataFrame:
    """Records valid in the version with ordinal ``seq``.

    A history built without ``break_on_gap`` also returns keys that skipped
    that version and came back unchanged.
    """
    at = F.lit(seq) if isinstance(seq, int) else seq
    return fact.filter((F.col("valid_from_seq") <= at) & (at <= F.col("valid_to_seq")))


def restatement_history(
    fact: DataFrame,
    key: Sequence[str],
    measure: str,
    carry: Sequence[str] = (),
    prefix: str | None = None,
) -> DataFrame:
    """One row per record after the first of its key: what it said before and after.

    A row appears if any compared column changed, so the delta of ``measure``
    may be 0, or NULL where either side was withheld.
    """
    name = prefix or measure
    status = f"{measure}_status"
    by_key = Window.partitionBy(*key).orderBy("valid_from_seq")
    versioned = fact.select(
        *key,
        *carry,
        F.lag("valid_from_version").over(by_key).alias("restated_from_version"),
        F.col("valid_from_version").alias("restated_in_version"),
        F.col("valid_from_published").alias("restated_on"),
        F.lag(measure).over(by_key).alias("_before"),
        F.col(measure).alias("_after"),
        F.lag(status).over(by_key).alias("status_before"),
        F.col(status).alias("status_after"),
    )
    delta = F.col("_after") - F.col("_before")
    return versioned.filter(F.col("restated_from_version").isNotNull()).select(
        *key,
        *carry,
        "restated_from_version",
        "restated_in_version",
        "restated_on",
        F.col("_before").alias(f"{name}_before"),
        F.col("_after").alias(f"{name}_after"),
        delta.alias(f"{name}_delta"),
        safe_divide(delta, F.col("_before")).alias(f"{name}_pct_change"),
        "status_before",
        "status_after",
        (F.col("status_before") != F.col("status_after")).alias("disclosure_status_changed"),
    )


def version_deltas(
    df: DataFrame,
    key: Sequence[str],
    seq: str,
    compare: Mapping[str, Sequence[str]],
    versions: DataFrame,
) -> DataFrame:
    """Rows added, removed and restated per version against the one before.

    ``compare`` names each kind of restatement and the columns that define it.
    A key's neighbouring versions come from one window, which replaces a full
    outer join per pair of versions. Which version follows which is read from
    ``versions``, so ordinals may have gaps.
    """
    by_seq = Window.orderBy(seq)  # one row per version
    listed = versions.select(seq, "version", "version_type").withColumns(
        {"_previous": F.lag(seq).over(by_seq), "_following": F.lead(seq).over(by_seq)}
    )
    by_key = Window.partitionBy(*key).orderBy(seq)
    before, after = F.lag(seq).over(by_key), F.lead(seq).over(by_key)
    adjacent = F.coalesce(before == F.col("_previous"), F.lit(False))
    rows = df.join(listed.select(seq, "_previous", "_following"), seq).select(
        seq,
        "_following",
        (~adjacent).alias("_added"),
        F.coalesce(after != F.col("_following"), F.lit(True)).alias("_dropped"),
        *[(adjacent & _differs(cols, by_key)).alias(name) for name, cols in compare.items()],
    )
    counted = rows.groupBy(seq).agg(
        F.first("_following").alias("_following"),
        F.count("*").alias("n"),
        F.count_if("_added").alias("added"),
        F.count_if("_dropped").alias("dropped"),
        *[F.count_if(name).alias(name) for name in compare],
    )
    here = F.struct(
        F.col(seq),
        F.col("n").alias("row_count"),
        "added",
        F.lit(0).cast("bigint").alias("removed"),
        *compare,
    )
    zero = F.lit(0).cast("bigint")
    onward = F.struct(
        F.col("_following").alias(seq),
        zero.alias("row_count"),
        zero.alias("added"),
        F.col("dropped").alias("removed"),
        *[zero.alias(name) for name in compare],
    )
    totals = ["row_count", "added", "removed", *compare]
    return (
        counted.select(F.inline(F.array(here, onward)))
        .groupBy(seq)
        .agg(*[F.sum(c).alias(c) for c in totals])
        .join(listed, seq)
        .select(seq, "version", "version_type", *totals)
    )


def text_and_typed_records(
    df: DataFrame, key: Sequence[str], seq: str, text: Sequence[str], typed: Sequence[str]
) -> DataFrame:
    """How many history records a text comparison opens, and a typed one.

    Both counts come from one pass over one window; the difference is the
    number of records that reformatting alone would have opened.
    """
    by_key = Window.partitionBy(*key).orderBy(seq)
    first = F.lag(seq).over(by_key).isNull()
    opened = df.select(
        (first | _differs(text, by_key)).alias("text"),
        (first | _differs(typed, by_key)).alias("typed"),
    ).agg(F.count_if("text").alias("text"), F.count_if("typed").alias("typed"))
    # Row labels of the report.
    return opened.select(
        F.stack(
            F.lit(2),
            F.lit("STRING diff (naive)"),
            F.col("text"),
            F.lit("TYPED diff (shipped)"),
            F.col("typed"),
        ).alias("method", "scd2_records")
    )
