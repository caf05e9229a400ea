"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a class, rows in all, and bytes of a text that may take part in fitting.
PER_CLASS = 1000
ROWS = 4000
TEXT_BYTES = 20_000
# Drawn beyond what is wanted, since a draw by hash gives a number near its mean only.
MARGIN = 1.3
DRAW_BITS = 40


def fold(modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as the text null."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), F.lit(modulus))


def drawn_rows(
    rows: DataFrame, label: str, order: Column, per_class: int = PER_CLASS, total: int = ROWS
) -> DataFrame:
    """Rows drawn by the hash ``order``, each label at its own rate, with the hash as ``draw``.

    Nothing is shuffled but counts by label.
    """
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(total).collect()
    per_class = max(1, min(per_class, total // max(1, len(counts))))
    # At most ``total`` entries; a lookup in each row, where a join would deal the texts by label.
    limits = {
        r[label]: min(1.0, MARGIN * per_class / r["count"]) * float(1 << DRAW_BITS)
        for r in counts
        if r[label] is not None
    }
    if not limits:
        return rows.withColumn("draw", F.lit(0).cast("bigint")).limit(0)
    known = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    draw = F.shiftrightunsigned(order, 64 - DRAW_BITS)
    return rows.withColumn("draw", draw).where(F.col("draw") < known[F.col(label)])


def gathered(
    drawn: DataFrame, label: str, per_class: int = PER_CLASS, total: int = ROWS
) -> list[tuple[str, object]]:
    """At most ``total`` pairs of text and label of drawn rows, the labels taking turns.

    Only these reach the driver: ``2 * total`` times ``TEXT_BYTES`` is the most. Longer texts don't take part.
    """
    fit = drawn.where(F.octet_length("text") <= TEXT_BYTES).select("text", label, "draw")
    taken: dict[object, int] = {}
    ranked = []
    for row in sorted(fit.orderBy("draw").limit(2 * total).collect(), key=lambda r: (r["draw"], r["text"])):
        n = taken[row[label]] = taken.get(row[label], 0) + 1
        if n <= per_class:
            ranked.append((n, row["draw"], row["text"], row[label]))
    return [(text, value) for _, _, text, value in sorted(ranked, key=lambda r: r[:3])][:total]
