"""Substring deduplication: repeated windows of words, found behind a count-min prefilter.

A window is ``WIDTH`` consecutive words of one text. Each word covered by a window whose words also start
earlier in the corpus (smaller doc_id, or the same text further up) is removed.

1. *Sketch.* Every window has an anchor: the run of ``ANCHOR`` words in it with the smallest hash. Windows
   with the same words have the same anchor, so an anchor occurs at least as often as any of its
   windows. Tasks count the anchors of their texts in a count-min sketch with saturating counters
   (none, one, more). The sketches travel as compressed blocks and are merged block by block. The merged
   sketch has a fixed size, whatever the corpus, and is broadcast.
2. *Candidates.* Windows whose anchor may be repeated by the sketch's estimate, which is never too
   low, so none is lost. A task keeps the first copy of each window per piece of text and reports later ones as
   removed, which bounds the rows of any window by the number of pieces.
3. *Exact groups.* Candidates are shuffled by anchor, as one row per anchor with the hashes of its windows.
   Windows with equal anchor and window hash (64 bits each) are one group; its first member stays.
4. *Removal.* Starts of removed windows are gathered per text and applied to its words.

When a corpus outgrows the sketch, more anchors pass it: step 3 then sees up to one row per anchor, some
sixth of the words, and the result is the same.

Defined cases: a null text has no words; fewer than ``WIDTH`` words have no window and stay whole. Rows with
equal doc_id are one after the other in the order of their text; rows equal in both are copies of which
the first in the scan's order stays. A null doc_id comes first. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statledger.llm.arrays import Words, find_words, mix, pieces, runs, text_bytes
from statledger.session import written

WIDTH = 20
ANCHOR = 8
# Sketch: rows, cells in a row, and blocks a row is cut into. Two bits a cell: 2 x 2^26 cells are 32 MiB.
ROWS = 2
CELL_BITS = 26
BLOCK_BITS = 18

_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def anchors(words: Words, width: int = WIDTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Window starts, window hashes, and the anchor's hash and place of every window."""
    values, at = runs(words, width, seed=1)
    if not len(at):
        return at, values, values, at
    n = len(words.hash) - anchor + 1
    own = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    grams, places = runs(words, anchor, seed=2)
    own[places] = grams
    span = width - anchor + 1
    best, where = own[at], at.copy()
    for j in range(1, span):
        other = own[at + j]
        lower = other < best
        best = np.where(lower, other, best)
        where = np.where(lower, at + j, where)
    return at, values, best, where


def _cells(hashes: np.ndarray, row: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(hashes * _SEEDS[row]) >> np.uint64(64 - CELL_BITS)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sketch of one task's texts: blocks of sorted cell numbers, seen once or more often."""
    once = [np.zeros(1 << CELL_BITS >> 3, np.uint8) for _ in range(ROWS)]
    more = [np.zeros(1 << CELL_BITS >> 3, np.uint8) for _ in range(ROWS)]
    for batch in batches:
        for piece in pieces(batch):
            words = find_words(piece.column("text"))
            _, _, value, where = anchors(words)
            if not len(where):
                continue
            # One window after another shares its anchor; count each place once.
            value = value[np.diff(where, prepend=-1) != 0]
            for r in range(ROWS):
                cells, n = np.unique(_cells(value, r), return_counts=True)
                known = _bits(once[r], cells)
                _mark(more[r], cells[known | (n > 1)])
                _mark(once[r], cells)
    block = 1 << BLOCK_BITS >> 3
    for r in range(ROWS):
        for k in range(1 << (CELL_BITS - BLOCK_BITS)):
            part = once[r][k * block : (k + 1) * block]
            if part.any():
                yield _block_row(r, k, part, more[r][k * block : (k + 1) * block])


def _block_row(row: int, block: int, once: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
    packed = zlib.compress(once.tobytes() + more.tobytes(), 1)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row * (1 << (CELL_BITS - BLOCK_BITS)) + block], pa.int32()),
            pa.array([packed], pa.binary()),
        ],
        ["block", "cells"],
    )


def _bits(table: np.ndarray, cells: np.ndarray) -> np.ndarray:
    shift = (cells & np.uint64(7)).astype(np.uint8)
    return (table[cells >> np.uint64(3)] >> shift & np.uint8(1)).astype(bool)


def _mark(table: np.ndarray, cells: np.ndarray) -> None:
    np.bitwise_or.at(
        table, cells >> np.uint64(3), np.uint8(1) << (cells & np.uint64(7)).astype(np.uint8)
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the sketches of a block, saturating at two; batches come one by one."""
    half = 1 << BLOCK_BITS >> 3
    merged: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(
            batch.column("block").to_pylist(), batch.column("cells").to_pylist(), strict=True
        ):
            new = np.frombuffer(zlib.decompress(packed), np.uint8)
            if block not in merged:
                merged[block] = new.copy()
                continue
            old = merged[block]
            old[half:] |= new[half:] | (old[:half] & new[:half])
            old[:half] |= new[:half]
    for block, cells in merged.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int32()),
                pa.array([zlib.compress(cells[half:].tobytes(), 1)], pa.binary()),
            ],
            ["block", "cells"],
        )


def merged_sketch(docs: DataFrame) -> list[np.ndarray]:
    """For each row of the sketch, a bit for every cell that counted two or more."""
    schema = "block int, cells binary"
    parts = docs.select("text").mapInArrow(_sketch, schema)
    blocks = ROWS << (CELL_BITS - BLOCK_BITS)
    merged = parts.repartition(min(blocks, 64), "block").mapInArrow(_merge, schema)
    tables = [np.zeros(1 << CELL_BITS >> 3, np.uint8) for _ in range(ROWS)]
    size = 1 << BLOCK_BITS >> 3
    per_row = 1 << (CELL_BITS - BLOCK_BITS)
    for row in merged.collect():
        table, k = tables[row["block"] // per_row], row["block"] % per_row
        table[k * size : (k + 1) * size] = np.frombuffer(zlib.decompress(row["cells"]), np.uint8)
    return tables


def _candidates(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per anchor that may be repeated, its windows; later copies within a piece marked at once."""
    tables = shared.value
    for batch in batches:
        for piece in pieces(batch):
            words = find_words(piece.column("text"))
            at, window, value, where = anchors(words)
            kept = np.ones(len(at), bool)
            for r in range(ROWS):
                kept &= _bits(tables[r], _cells(value, r))
            kept = np.flatnonzero(kept)
            at, window, value, where = at[kept], window[kept], value[kept], where[kept]
            rows = np.repeat(np.arange(len(words.first) - 1), words.counts)[at]
            # Texts of a piece in the order of the corpus; numpy sorts it once.
            order = _text_order(piece)
            ranks = order[rows]
            sort = np.lexsort((at, ranks, window, value))
            new = np.ones(len(sort), bool)
            new[1:] = (window[sort][1:] != window[sort][:-1]) | (value[sort][1:] != value[sort][:-1])
            first = np.zeros(len(sort), bool)
            first[sort[new]] = True
            yield from _candidate_rows(piece, words, rows, at, window, value, where, first)


def _text_order(piece: pa.RecordBatch) -> np.ndarray:
    """The place of each row in the order of doc_id and key, nulls first."""
    ids = piece.column("doc_id")
    known = np.asarray(ids.is_valid())
    numbers = np.asarray(ids.fill_null(0), dtype=np.int64)
    keys = np.asarray(piece.column("key"), dtype=np.int64)
    rows = np.asarray(piece.column("row"), dtype=np.int64)
    order = np.empty(len(ids), np.int64)
    order[np.lexsort((rows, keys, numbers, known))] = np.arange(len(ids))
    return order


_CANDIDATES = (
    "row bigint, doc_id bigint, key bigint, anchor bigint, place int, done boolean, windows array<bigint>"
)


def _candidate_rows(piece, words, rows, at, window, value, where, first) -> Iterator[pa.RecordBatch]:
    """A row per run of neighbouring windows with one anchor that are alike in ``first``."""
    if not len(at):
        return
    start = at - words.first[rows]
    cut = np.ones(len(at), bool)
    cut[1:] = (
        (where[1:] != where[:-1]) | (first[1:] != first[:-1]) | (at[1:] != at[:-1] + 1)
    )
    heads = np.flatnonzero(cut)
    offsets = np.append(heads, len(at)).astype(np.int32)
    own = rows[heads]
    yield pa.RecordBatch.from_arrays(
        [
            piece.column("row").take(pa.array(own)),
            piece.column("doc_id").take(pa.array(own)),
            piece.column("key").take(pa.array(own)),
            pa.array(value[heads].view(np.int64)),
            pa.array(start[heads].astype(np.int32)),
            pa.array(~first[heads]),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(window.view(np.int64))),
        ],
        ["row", "doc_id", "key", "anchor", "place", "done", "windows"],
    )


def removed_windows(docs: DataFrame) -> DataFrame:
    """``(row, starts)``: for rows of ``docs`` that lose words, the removed windows' first words.

    ``docs`` has doc_id, key, row and text, as ``numbered`` makes them, and is stored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(merged_sketch(docs))
    found = docs.select("row", "doc_id", "key", "text").mapInArrow(
        partial(_candidates, shared), _CANDIDATES
    )
    # Later copies within a piece need no group of their own; a random key spreads them.
    spread = F.when(F.col("done"), F.xxhash64("row", "place")).otherwise(F.col("anchor"))
    dealt = found.withColumn("anchor", spread).repartition("anchor")
    each = dealt.select(
        "row", "doc_id", "key", "anchor", "place", "done", F.posexplode("windows").alias("k", "window")
    ).withColumn("place", F.col("place") + F.col("k"))
    order = [F.col("doc_id").asc_nulls_first(), "key", "row", "place"]
    group = Window.partitionBy("anchor", "window").orderBy(*order)
    later = each.withColumn("n", F.when(~F.col("done"), F.row_number().over(group)))
    return (
        later.where("done OR n > 1")
        .groupBy("row")
        .agg(F.collect_list("place").alias("starts"))
    )


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id and text with a key of the text and a number that tells equal rows apart."""
    return docs.select(
        "doc_id",
        "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            kept, counts, removed = _kept_words(piece)
            names = ["doc_id", "n_words", "n_removed", "kept"]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names,
            )


def _kept_words(piece: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The kept words of each text joined by spaces, and how many words it had and lost."""
    texts = piece.column("text")
    data, _ = text_bytes(texts)
    words = find_words(texts)
    lists = piece.column("starts")
    lost = np.zeros(len(words.hash) + 1, np.int64)
    for k in np.flatnonzero(np.asarray(lists.is_valid())):
        starts = np.asarray(lists[int(k)].values, dtype=np.int64) + words.first[k]
        np.add.at(lost, starts, 1)
        np.add.at(lost, starts + WIDTH, -1)
    gone = np.cumsum(lost[:-1]) > 0
    counts = words.counts
    removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1])
    removed = np.where(counts > 0, removed, 0)
    stay = np.flatnonzero(~gone)
    length = words.length[stay]
    ends = np.cumsum(length + 1)
    # Where each kept byte comes from and goes to; a space follows every word.
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    joined = np.full(ends[-1] if len(ends) else 0, 0x20, np.uint8)
    joined[np.repeat(ends - length - 1, length) + within] = data[
        np.repeat(words.start[stay], length) + within
    ]
    bounds = np.append(0, ends)[np.searchsorted(stay, words.first)]
    out = [joined[i : max(i, j - 1)].tobytes() for i, j in zip(bounds, bounds[1:], strict=False)]
    return out, counts, removed


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every row; ``kept`` is UTF-8."""
    # Stored, as a number depends on how a scan is split: what is removed finds its text whatever executors there are.
    rows = written(numbered(docs), "substring-texts")
    starts = removed_windows(rows)
    joined = rows.join(starts.hint("shuffle_hash"), "row", "left")
    return joined.select("doc_id", "text", "starts").mapInArrow(
        _remove, "doc_id bigint, n_words bigint, n_removed bigint, kept binary"
    )


def substring_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
