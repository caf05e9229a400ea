"""Hard negatives by Kronecker-packed products of whole-number embeddings.

Components become ``floor(256 * x)``; a score is an exact inner product. Components of several candidates are
shifted to be non-negative and put side by side into separated fields of one wide number; one multiplication with an
anchor's component serves them all, and the sum over components holds one score a field, as the fields are wide
enough for the largest possible sum. Up to 53 bits the wide number is a double that holds a whole number exactly, so the
products are one matrix product; fields that do not fit are packed into one long Python number instead.

All rows are stored once in blocks. Anchors are taken in groups of bounded size, each broadcast to one pass over the
blocks for its positives and one for its negatives: a stated query set against all rows, in blocks. A task keeps
the best few per anchor (and positive), and those are merged anchor chunk by anchor chunk. No row is shuffled
by label, so a label with a third of all rows costs as much as any other.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part. Components that
a shorter vector lacks count 0; those beyond 2**56 in size count as that, and a score beyond a long counts as the nearest long. A
null id is no anchor, and comes last among equal scores. Repeated rows are rows of their own, so an anchor's copy can be
its positive. An anchor without positives, or without negatives in range, has no rows; a positive of negative
score never has. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.llm.whitening import finite, narrow, whole_cells
from statledger.session import scratch_path, written

SCALE = 256
POSITIVES = NEGATIVES = 5
ANCHOR_STEP = 100
# Least share of the positive's score that a hard negative has, in percent.
SHARE = 80
# Rows of a block, anchors compared with it at once, and bounds of a group of anchors.
BLOCK = 2048
CHUNK = 512
GROUP_ANCHORS = 1 << 15
GROUP_BYTES = 32 << 20
EXACT_BITS = 53
LOW = -(1 << 63)
HIGH = (1 << 63) - 1

_BLOCKS = "ids array<bigint>, rows array<bigint>, labels array<bigint>, dims int, kind string, cells binary"
_BEST = "chunk int, owner binary, score binary, id binary, row binary"
_TRIPLES = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint"
)


def packed_scores(anchors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """All inner products of whole-number rows, exactly."""
    if not len(anchors) or not len(others):
        return np.zeros((len(anchors), len(others)), np.int64)
    up, over = -min(int(anchors.min(initial=0)), 0), -min(int(others.min(initial=0)), 0)
    most = max(int(anchors.max(initial=0)) + up, 1) * max(int(others.max(initial=0)) + over, 1)
    fields = EXACT_BITS // (most * max(anchors.shape[1], 1)).bit_length()
    if not fields:
        return _long_scores(anchors, others, up, over)
    width = EXACT_BITS // fields
    left, right = anchors + up, others + over
    padded = np.zeros((-(-len(right) // fields) * fields, right.shape[1]))
    padded[: len(right)] = right
    places = np.ldexp(1.0, width * np.arange(fields))
    packed = np.einsum("gfd,f->gd", padded.reshape(-1, fields, right.shape[1]), places)
    total = (left.astype(np.float64) @ packed.T).astype(np.int64)
    mask = (1 << width) - 1
    apart = np.stack([total >> (width * f) & mask for f in range(fields)], axis=2)
    found = apart.reshape(len(left), -1)[:, : len(right)]
    return found - over * anchors.sum(axis=1)[:, None] - up * right.sum(axis=1)[None, :]


def _long_scores(anchors: np.ndarray, others: np.ndarray, up: int, over: int) -> np.ndarray:
    """The same with fields of any width in one long number; results beyond a long are cut to it."""
    left = [[v + up for v in row] for row in anchors.tolist()]
    right = [[v + over for v in row] for row in others.tolist()]
    most = max(map(max, left)) * max(map(max, right)) * len(left[0])
    size = (most.bit_length() + 8) // 8
    packed = [int.from_bytes(b"".join(row[j].to_bytes(size, "little") for row in right), "little") for j in range(len(left[0]))]
    sums = [sum(row) for row in right]
    found = np.empty((len(left), len(right)), np.int64)
    for i, (row, own) in enumerate(zip(left, anchors.tolist(), strict=True)):
        total = sum(a * p for a, p in zip(row, packed, strict=True)).to_bytes(size * len(right) + size, "little")
        for k in range(len(right)):
            field = int.from_bytes(total[k * size : (k + 1) * size], "little")
            found[i, k] = min(max(field - over * sum(own) - up * sums[k], LOW + 1), HIGH)
    return found


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            vectors = part.column("vector")
            lengths = np.asarray(vectors.value_lengths(), dtype=np.int64)
            cells = np.zeros((part.num_rows, int(lengths.max(initial=0))), np.int64)
            cells[np.arange(cells.shape[1]) < lengths[:, None]] = whole_cells(
                vectors.flatten().to_numpy(zero_copy_only=False), SCALE
            )
            cells = narrow(cells)
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.ListArray.from_arrays([0, part.num_rows], part.column(c)) for c in ("id", "row", "label")],
                    pa.array([cells.shape[1]], pa.int32()),
                    pa.array([cells.dtype.str]),
                    pa.array([cells.tobytes()], pa.binary()),
                ],
                ["ids", "rows", "labels", "dims", "kind", "cells"],
            )


@dataclass
class Block:
    """Rows as arrays. A null id is ``HIGH``, with the row number negated."""

    ids: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    cells: np.ndarray

    def take(self, which) -> Block:
        return Block(self.ids[which], self.rows[which], self.labels[which], self.cells[which])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids = batch.column("ids")[k].values
            null = np.asarray(ids.is_null())
            rows = batch.column("rows")[k].values.to_numpy()
            kind = np.dtype(batch.column("kind")[k].as_py())
            cells = np.frombuffer(batch.column("cells")[k].as_buffer(), kind)
            yield Block(
                ids.fill_null(HIGH).to_numpy(),
                np.where(null, ~rows, rows),
                batch.column("labels")[k].values.to_numpy(),
                cells.reshape(len(rows), batch.column("dims")[k].as_py()).astype(np.int64),
            )


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


class Best:
    """The best ``k`` entries of each of ``n`` owners: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.owner = self.score = self.id = self.row = np.zeros(0, np.int64)
        self.floor = np.full(n, LOW)

    def offer(self, owner, score, ids, rows) -> None:
        owner, score, ids, rows = (
            np.concatenate([mine, new])
            for mine, new in ((self.owner, owner), (self.score, score), (self.id, ids), (self.row, rows))
        )
        order = np.lexsort((rows, ids, -score, owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = order[place < self.k]
        last = order[place == self.k - 1]
        self.owner, self.score, self.id, self.row = owner[place < self.k], score[keep], ids[keep], rows[keep]
        self.floor[owner[place == self.k - 1]] = score[last]

    def offer_block(self, owners: np.ndarray, scores: np.ndarray, allowed: np.ndarray, block: Block) -> None:
        """Entries of a score matrix, a row per owner, that may be among the best."""
        allowed = allowed & (scores >= self.floor[owners][:, None])
        if scores.shape[1] > self.k:
            held = np.where(allowed, scores, LOW)
            least = np.partition(held, -self.k, axis=1)[:, -self.k]
            allowed &= scores >= least[:, None]
        a, c = np.nonzero(allowed)
        if len(a):
            self.offer(owners[a], scores[a, c], block.ids[c], block.rows[c])

    def batch(self, chunk: int) -> pa.RecordBatch:
        held = [x.astype(np.int64).tobytes() for x in (self.owner, self.score, self.id, self.row)]
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int32()), *[pa.array([h], pa.binary()) for h in held]],
            ["chunk", "owner", "score", "id", "row"],
        )


def _chunks(anchors: Block, size: int) -> list[Block]:
    return [anchors.take(slice(k, k + size)) for k in range(0, len(anchors.ids), size)]


def _find_positives(size: int, sent, batches) -> Iterator[pa.RecordBatch]:
    chunks = _chunks(sent.value, size)
    best = [Best(len(c.ids), POSITIVES) for c in chunks]
    for block in _blocks(batches):
        for chunk, held in zip(chunks, best, strict=True):
            for label in np.intersect1d(chunk.labels, block.labels):
                mine, theirs = np.flatnonzero(chunk.labels == label), block.take(block.labels == label)
                scores = packed_scores(*_same_width(chunk.cells[mine], theirs.cells))
                held.offer_block(mine, scores, chunk.rows[mine][:, None] != theirs.rows[None, :], theirs)
    for k, held in enumerate(best):
        yield held.batch(k)


def _least_negative(score: np.ndarray) -> np.ndarray:
    """The least whole number that is ``SHARE`` percent of a score or more, without leaving longs."""
    return score // 100 * SHARE - (-(score % 100) * SHARE) // 100


def _find_negatives(size: int, sent, batches) -> Iterator[pa.RecordBatch]:
    anchors, positives = sent.value
    chunks = _chunks(anchors, size)
    best = [Best(len(c.ids) * POSITIVES, NEGATIVES) for c in chunks]
    for block in _blocks(batches):
        for chunk, held, (found, tops) in zip(chunks, best, positives, strict=True):
            scores = packed_scores(*_same_width(chunk.cells, block.cells))
            other = chunk.labels[:, None] != block.labels[None, :]
            for i in range(POSITIVES):
                has = np.flatnonzero(found > i)
                top = tops[has, i][:, None]
                near = other[has] & (scores[has] <= top) & (scores[has] >= _least_negative(top))
                held.offer_block(has * POSITIVES + i, scores[has], near, block)
    for k, held in enumerate(best):
        yield held.batch(k)


def _merged(sizes: list[int], k: int, batches) -> Iterator[tuple[int, Best]]:
    """Best entries of each anchor chunk over all tasks; a chunk's entries are bounded by its anchors."""
    merged: dict[int, Best] = {}
    for batch in batches:
        for r in range(batch.num_rows):
            chunk = batch.column("chunk")[r].as_py()
            held = merged.setdefault(chunk, Best(sizes[chunk], k))
            held.offer(*[np.frombuffer(batch.column(c)[r].as_buffer(), np.int64) for c in ("owner", "score", "id", "row")])
    yield from merged.items()


def _merge_positives(sizes: list[int], batches) -> Iterator[pa.RecordBatch]:
    for chunk, held in _merged(sizes, POSITIVES, batches):
        yield held.batch(chunk)


def _ranked(held: Best) -> np.ndarray:
    return np.arange(len(held.owner)) - np.searchsorted(held.owner, held.owner)


def _merge_negatives(sizes: list[int], sent, batches) -> Iterator[pa.RecordBatch]:
    anchors, positive = sent.value
    for chunk, held in _merged([s * POSITIVES for s in sizes], NEGATIVES, batches):
        own, place = held.owner // POSITIVES, held.owner % POSITIVES
        score, ids, rows = (positive[chunk][k][own, place] for k in range(3))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchors[chunk][own]),
                pa.array(ids, mask=rows < 0),
                pa.array(_ranked(held).astype(np.int32) + 1),
                pa.array(held.id, mask=held.row < 0),
                pa.array(score),
                pa.array(held.score),
            ],
            ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
        )


def _group(stored: DataFrame, group: int, groups: int) -> Block:
    """The anchors of one group, which is bounded by the number of groups."""
    parts = list(_blocks(stored.where(F.col("group") == group).toArrow().to_batches()))
    width = max((p.cells.shape[1] for p in parts), default=0)
    cells = [np.pad(p.cells, ((0, 0), (0, width - p.cells.shape[1]))) for p in parts]
    return Block(*[np.concatenate([getattr(p, c) for p in parts]) for c in ("ids", "rows", "labels")], np.concatenate(cells))


def _anchor_blocks(groups: int, step: int, batches) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        chosen = (block.ids % step == 0) & (block.rows >= 0)
        anchors = block.take(chosen)
        for group in np.unique(anchors.rows % groups):
            part = anchors.take(anchors.rows % groups == group)
            cells = narrow(part.cells)
            lists = [pa.ListArray.from_arrays([0, len(part.ids)], pa.array(x)) for x in (part.ids, part.rows, part.labels)]
            yield pa.RecordBatch.from_arrays(
                [
                    *lists,
                    pa.array([cells.shape[1]], pa.int32()),
                    pa.array([cells.dtype.str]),
                    pa.array([cells.tobytes()], pa.binary()),
                    pa.array([int(group)], pa.int64()),
                ],
                ["ids", "rows", "labels", "dims", "kind", "cells", "group"],
            )


def _mine_group(blocks: DataFrame, anchors: Block) -> DataFrame:
    context = blocks.sparkSession.sparkContext
    chunks = _chunks(anchors, CHUNK)
    sizes = [len(c.ids) for c in chunks]
    near = (
        blocks.mapInArrow(partial(_find_positives, CHUNK, context.broadcast(anchors)), _BEST)
        .repartition("chunk")
        .mapInArrow(partial(_merge_positives, sizes), _BEST)
        .collect()  # at most POSITIVES entries for each anchor of the group
    )
    # Per chunk, by anchor and place: score, id and row of the positives.
    positive = [tuple(np.zeros((n, POSITIVES), np.int64) for _ in range(3)) for n in sizes]
    counts = [np.zeros(n, np.int64) for n in sizes]
    for r in near:
        owner, *held = (np.frombuffer(r[c], np.int64) for c in ("owner", "score", "id", "row"))
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        counts[r["chunk"]] = np.bincount(owner, minlength=sizes[r["chunk"]])
        for target, values in zip(positive[r["chunk"]], held, strict=True):
            target[owner, place] = values
    tops = [(n, p[0]) for n, p in zip(counts, positive, strict=True)]
    anchor_ids = [c.ids for c in chunks]
    return (
        blocks.mapInArrow(partial(_find_negatives, CHUNK, context.broadcast((anchors, tops))), _BEST)
        .repartition("chunk")
        .mapInArrow(partial(_merge_negatives, sizes, context.broadcast((anchor_ids, positive))), _TRIPLES)
    )


def hard_negatives(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """For each anchor and each of its positives the hard negatives, with scores and rank.

    Anchors are the rows whose id is divisible by ``ANCHOR_STEP``. Labels are taken as they are.
    """
    spark = vectors.sparkSession
    kept = vectors.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(label_column).cast("bigint").alias("label"),
        F.col(vector_column).alias("vector"),
        F.monotonically_increasing_id().alias("row"),  # stored with the blocks, never computed again
    ).where(F.col("label").isNotNull() & finite("vector"))
    blocks = written(kept.mapInArrow(_to_blocks, _BLOCKS), "negatives-blocks")
    chosen = F.size(F.filter("ids", lambda i: i % ANCHOR_STEP == 0))
    n, dims = blocks.agg(F.sum(chosen), F.max("dims")).first()
    groups = max(1, math.ceil((n or 0) / GROUP_ANCHORS), math.ceil((n or 0) * (dims or 0) * 8 / GROUP_BYTES))
    target = scratch_path(spark, "negatives-found")
    spark.createDataFrame([], _TRIPLES).write.mode("append").parquet(target)
    if n:
        anchors = written(blocks.mapInArrow(partial(_anchor_blocks, groups, ANCHOR_STEP), f"{_BLOCKS}, group bigint"), "negatives-anchors")
        for group in range(groups):
            own = _group(anchors, group, groups)
            if len(own.ids):
                _mine_group(blocks, own).write.mode("append").parquet(target)
    return spark.read.schema(_TRIPLES).parquet(target)


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """Labels as the query wants them: moved on by one, modulo 10, where the id is divisible by 7."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)


def negatives_report(vectors: DataFrame) -> DataFrame:
    return hard_negatives(shifted_labels(vectors.select("vec_id", "embedding", "label")))


ORACLE = """
WITH kept AS (
  SELECT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS cells,
         row_number() OVER () AS row_no
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.row_no AS anchor_row, a.label = b.label AS same,
         b.vec_id AS other_id, b.row_no AS other_row,
         CAST(list_sum(list_transform(list_zip(a.cells, b.cells), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.row_no <> b.row_no
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, other_id, other_row) <= 5
), near AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (
           PARTITION BY p.anchor_row, p.other_row ORDER BY n.score DESC, n.other_id, n.other_row
         ) AS place
  FROM positives p JOIN scored n ON p.anchor_row = n.anchor_row
  WHERE NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM near WHERE place <= 5
"""
