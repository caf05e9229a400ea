"""Document fingerprints by winnowing.

Every run of ``K`` code points has a rolling hash, made from the one before by one point coming in and one going out. Of
each window of ``W`` consecutive hashes the least is kept, the rightmost among equal ones, with its position. So any two
texts that share ``W + K - 1`` consecutive code points share a fingerprint entry at the places of that run, and
about two of ``W + 1`` hashes are kept. Fewer hashes than a window form one window; a text shorter than ``K`` is one run.
Hashes have 40 bits and cover code points unchanged.

The report compares each text with an edited one, whose second half comes from the next document in falling doc_id, and with that
document. Likeness is the Dice coefficient of the distinct hashes, 1 for two empty fingerprints. Texts are dealt once,
by ranges of doc_id; each range also gets the first document of the next one, so neighbours always meet
in one task and nothing is sorted in one place. An id that fills several ranges is dealt by a hash of its texts.

Defined cases: a null text is empty and has an empty fingerprint. A null doc_id comes last. Equal ids are ordered by
a hash of the text, falling. Equal rows follow each other and are all returned. A single row is its own next document. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.llm.arrays import mix, pieces

K = 12
W = 21
POSITION_BITS = 24
SEGMENT = 1 << 23
LAST_ID = -(1 << 63)
# Text bytes of a range, most partitions, and ranges to a partition.
RANGE_BYTES = 8 << 20
MOST_PARTITIONS = 20_000
RANGES_EACH = 4
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 14), base, np.uint64)
        steps[0] = 1
        held = np.cumprod(steps, dtype=np.uint64)
        if n <= SEGMENT:
            _POWERS[base] = held
    return held[:n]


def gram_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of each run of ``k`` code points, or of all of a shorter text."""
    n = len(points)
    k = min(k, n)
    if not n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:], dtype=np.uint64)
        return mix((sums[k:] - sums[:-k]) * _powers(_INVERSE, n - k + 1) + np.uint64(k))


def window_least(keys: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` consecutive keys, by doubling the width."""
    width = 1
    while 2 * width <= w:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    return keys if width == w else np.minimum(keys[: len(keys) - (w - width)], keys[w - width :])


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions, in order of position."""
    hashes = gram_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), k)
    if not len(hashes):
        return hashes, np.zeros(0, np.int64)
    w = min(w, len(hashes))
    low = np.uint64((1 << POSITION_BITS) - 1)
    kept, places = [], []
    for start in range(0, len(hashes) - w + 1, SEGMENT):
        part = hashes[start : start + SEGMENT + w - 1]
        # Later positions have smaller low bits, so the least key is the rightmost least hash.
        keys = (part & ~low) | (low - np.arange(len(part), dtype=np.uint64))
        least = window_least(keys, w)
        least = least[np.append(True, least[1:] != least[:-1])]
        kept.append(least >> np.uint64(POSITION_BITS))
        places.append((low - (least & low)).astype(np.int64) + start)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(kept)[first], places


def fingerprint_text(kept: np.ndarray, places: np.ndarray) -> str:
    """``hash:position`` with ten hexadecimal digits of hash, comma-joined."""
    return ",".join([f"{h:010x}:{p}" for h, p in zip(kept.tolist(), places.tolist(), strict=True)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of two sets of distinct hashes, 1 if both are empty."""
    if not len(a) + len(b):
        return 1.0
    return 2.0 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FINGERPRINTS = "doc_id bigint, fingerprint array<struct<hash: bigint, position: bigint>>"


def _fingerprints(k: int, w: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            made = [winnow(t or "", k, w) for t in piece.column("text").to_pylist()]
            ends = np.append(0, np.cumsum([len(p) for _, p in made])).astype(np.int32)
            entries = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([h for h, _ in made]).astype(np.int64)),
                    pa.array(np.concatenate([p for _, p in made]).astype(np.int64)),
                ],
                ["hash", "position"],
            )
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), entries)], ["doc_id", "fingerprint"]
            )


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """The kept hashes and positions of every text, in order of position; no shuffle."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_fingerprints, k, w), _FINGERPRINTS)


# -- neighbours by falling doc_id ------------------------------------------------------


def _how_many(splits: list[int], holds) -> Column:
    """How many of the falling split points hold, which are a beginning of them; two short searches."""
    step = max(1, math.isqrt(len(splits)))
    groups = [splits[k : k + step] for k in range(0, len(splits), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    table = F.array(*[F.array(*[F.lit(s) for s in g]) for g in groups])
    full = F.size(F.filter(heads, holds)) - 1
    return F.when(full < 0, 0).otherwise(full * step + F.size(F.filter(F.get(table, full), holds)))


def _part(splits: list[int]) -> Column:
    """The range of a row, by its ``id`` and, where an id fills several ranges, its ``tie``."""
    if not splits:
        return F.lit(0)
    above = _how_many(splits, lambda s: s > F.col("id"))
    same = _how_many(splits, lambda s: s >= F.col("id")) - above
    share = 0.5 - F.col("tie").cast("double") / 2.0**64
    return (above + F.when(same > 1, F.least(same - 1, F.floor(share * same))).otherwise(0)).cast("int")


def ranged(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows with their range, and the number of partitions they are to be dealt to.

    Ranges follow approximate quantiles of the ids, so that they hold similar numbers of rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(LAST_ID)))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(least, min(math.ceil(size / (RANGE_BYTES * RANGES_EACH)), MOST_PARTITIONS))
    ranges = partitions * RANGES_EACH
    points = [k / ranges for k in range(ranges - 1, 0, -1)]
    splits = rows.agg(F.percentile_approx("id", points, max(10_000, 10 * ranges))).first()[0] or []
    return rows.withColumn("tie", F.xxhash64("text")).withColumn("part", _part(splits)), partitions


def with_next(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt and sorted by range; each range ends with the first row of the next one, marked ``after``."""
    spark = rows.sparkSession
    first = F.max(F.struct(F.col("doc_id").isNotNull().alias("has_id"), "id", "tie"))
    heads = rows.groupBy("part").agg(first.alias("head")).orderBy("part").collect()  # one per range
    order = [h["part"] for h in heads]
    targets = [
        (order[k - 1], h["head"]["has_id"], h["head"]["id"], h["head"]["tie"]) for k, h in enumerate(heads)
    ]
    wanted = spark.createDataFrame(targets, "target int, has_id boolean, at bigint, at_tie bigint")
    match = (
        (F.col("id") == F.col("at")) & (F.col("tie") == F.col("at_tie")) & (F.col("doc_id").isNotNull() == F.col("has_id"))
    )
    # A range has one head; the table of heads is bounded by the number of ranges.
    tails = rows.join(F.broadcast(wanted), match).dropDuplicates(["target"])
    both = rows.withColumn("after", F.lit(False)).unionByName(
        tails.select("doc_id", "text", "id", "tie", F.col("target").alias("part"), F.lit(True).alias("after"))
    )
    return both.repartition(partitions, "part").sortWithinPartitions(
        "part", "after", F.col("doc_id").isNull(), F.desc("id"), F.desc("tie")
    )


_REPORT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _report_row(doc_id, text: str, own, following: str, following_hashes: np.ndarray) -> tuple:
    kept, places = own
    changed = edited(text, following)
    hashes = np.unique(kept)
    other = own if changed == text else winnow(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        fingerprint_text(*own),
        fingerprint_text(*other),
        likeness(hashes, np.unique(other[0])),
        likeness(hashes, following_hashes),
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Report rows from sorted ranges; one row is held back until the next has come."""
    names = [c.split()[0] for c in _REPORT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None
    for batch in batches:
        for piece in pieces(batch):
            made = []
            columns = [piece.column(c).to_pylist() for c in ("doc_id", "text", "part", "after")]
            for doc_id, text, part, after in zip(*columns, strict=True):
                own = winnow(text)
                if held is not None and held[3] == part:
                    made.append(_report_row(*held[:3], text, np.unique(own[0])))
                held = None if after else (doc_id, text, own, part)
            columns = zip(*made, strict=True) if made else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names
            )


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to the edited text and the next document."""
    rows, partitions = ranged(docs)
    return with_next(rows, partitions).mapInArrow(_neighbours, _REPORT)
