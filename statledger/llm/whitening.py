"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation over Spark.

Entries become whole numbers, ``floor(64 * c)``, kept in blocks of rows in the narrowest whole type, so that sums are
exact and a pass reads little. With ``A`` the centred rows, every step alternates a product ``A v`` and a product ``At u``:

1. One pass forms ``r = A p`` for the next direction ``p`` and returns ``r.r``, ``At r`` and ``Ut r``, the part of ``r`` along
   all earlier left vectors. Left vectors are as long as the table and never stored: each is ``A w`` for a short ``w``, so a task
   makes its rows of all of them from the block at hand.
2. The driver takes the part along earlier left vectors off, which makes ``u`` and ``At u``, and takes the part along all
   earlier right vectors off ``At u``, twice, which makes the next ``v``: full reorthogonalisation on both sides.

A negligible norm starts anew from a random direction orthogonal to all before, so repeated and zero eigenvalues are met too. The
steps end when there are as many as dimensions, or when all wanted directions have converged and some
further steps from a new random direction change none. The small bidiagonal matrix is decomposed by the driver. What the
driver holds grows with the number of dimensions, never with rows.

Defined cases: a null vector, or one with a null or non-finite entry, is dropped, and so is one whose length is not the most
frequent (of equally frequent ones the greatest). Entries beyond 2**56 in size count as that. Directions without variance
have no component, so equal rows, one row or none give an empty result. A deviation too large for a long is null.
Repeated rows and ids each count and are each returned. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.session import written

SCALE = 64
COMPONENTS = 32
# Entries of a block: 2 MiB as doubles.
BLOCK_ENTRIES = 1 << 18
LARGEST = 1 << 56
# Below this share of the largest singular value a norm counts as zero.
NEGLIGIBLE = 1e-11
CONVERGED = 1e-13
# Steps from a new random direction that have to change nothing.
PROBE = 8
LONG_MAX = (1 << 63) - 1

_BLOCK = "ids array<bigint>, n int, kind string, cells binary"


def finite(vector: str):
    """Whether a vector and all its entries are there and finite."""
    entry_ok = F.forall(
        vector,
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))),
    )
    return F.col(vector).isNotNull() & F.coalesce(entry_ok, F.lit(False))


def whole_cells(flat: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * c)`` of doubles as longs."""
    with np.errstate(over="ignore"):
        scaled = np.floor(flat.astype(np.float64) * scale)
    return np.clip(scaled, -float(LARGEST), float(LARGEST)).astype(np.int64)


def narrow(cells: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest signed type."""
    low, high = (int(cells.min()), int(cells.max())) if cells.size else (0, 0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return cells.astype(kind)
    return cells


def _to_blocks(scale: int, dims: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    step = max(1, BLOCK_ENTRIES // max(dims, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            cells = narrow(whole_cells(part.column("vector").flatten().to_numpy(zero_copy_only=False), scale))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays([0, part.num_rows], part.column("id")),
                    pa.array([part.num_rows], pa.int32()),
                    pa.array([cells.dtype.str]),
                    pa.array([cells.tobytes()], pa.binary()),
                ],
                ["ids", "n", "kind", "cells"],
            )


def _cells(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole cells of each block."""
    for batch in batches:
        for k in range(batch.num_rows):
            kind = np.dtype(batch.column("kind")[k].as_py())
            cells = np.frombuffer(batch.column("cells")[k].as_buffer(), kind).reshape(-1, dims)
            yield batch.column("ids")[k].values, cells.astype(np.int64)


def _slots(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values.astype(np.float64))], ["slot", "value"]
    )


def _whole_sums(dims: int, batches) -> Iterator[pa.RecordBatch]:
    high, low, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
    for _, cells in _cells(batches, dims):
        high += (cells >> 32).sum(axis=0)
        low += (cells & 0xFFFFFFFF).sum(axis=0)
        n += len(cells)
    slots = pa.array(np.arange(dims, dtype=np.int32))
    yield pa.RecordBatch.from_arrays(
        [slots, pa.array(high), pa.array(low), pa.array(np.full(dims, n))], ["slot", "high", "low", "n"]
    )


@dataclass
class Centre:
    """Exact sums of ``n`` rows: per dimension ``n * whole + rest``, with ``0 <= rest < n``."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def centred(self, cells: np.ndarray) -> np.ndarray:
        return (cells - self.whole) - self.rest / self.n

    def deviations(self, cells: np.ndarray) -> list[int | None]:
        """Per row the sum over dimensions of ``(n * x - S) ** 2``, exactly."""
        off = cells - self.whole
        most = int(np.abs(off).max(initial=0)) + 1
        if off.shape[1] * (self.n * most) ** 2 < LONG_MAX:
            return ((self.n * off - self.rest) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * o - r) ** 2 for o, r in zip(row, self.rest.tolist(), strict=True)) for row in off.tolist()]
        return [e if e <= LONG_MAX else None for e in exact]


def _exact_centre(blocks: DataFrame, dims: int) -> Centre | None:
    sums = (
        blocks.mapInArrow(partial(_whole_sums, dims), "slot int, high bigint, low bigint, n bigint")
        .groupBy("slot")
        .agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")])
        .orderBy("slot")
        .collect()  # one row per dimension
    )
    n = int(sums[0]["n"]) if sums else 0
    if not n:
        return None
    totals = [(int(r["high"]) << 32) + int(r["low"]) for r in sums]
    return Centre(n, np.array([t // n for t in totals]), np.array([t % n for t in totals]))


def _gather(blocks: DataFrame, task, shared) -> np.ndarray:
    """Sums over all blocks of what ``task`` makes of its own, slot by slot."""
    sent = blocks.sparkSession.sparkContext.broadcast(shared)
    parts = blocks.mapInArrow(partial(task, sent), "slot int, value double")
    rows = parts.groupBy("slot").agg(F.sum("value").alias("value")).collect()  # a few per dimension
    sent.destroy()
    found = np.zeros(max(r["slot"] for r in rows) + 1)
    for r in rows:
        found[r["slot"]] = r["value"]
    return found


def _products(sent, batches) -> Iterator[pa.RecordBatch]:
    """``r.r``, the trace, ``At r`` and ``Ut r`` for ``r = A p``."""
    centre, p, left = sent.value
    total = np.zeros(2 + len(p) + left.shape[1])
    for _, cells in _cells(batches, len(p)):
        rows = centre.centred(cells)
        r = rows @ p
        total += np.concatenate([[r @ r, np.einsum("ij,ij", rows, rows)], rows.T @ r, (rows @ left).T @ r])
    yield _slots(total)


def _whitened_products(sent, batches) -> Iterator[pa.RecordBatch]:
    centre, maps = sent.value
    total = np.zeros(maps.shape[1] * (maps.shape[1] + 1))
    for _, cells in _cells(batches, len(maps)):
        made = centre.centred(cells) @ maps
        total += np.concatenate([made.sum(axis=0), (made.T @ made).ravel()])
    yield _slots(total)


class Bidiagonal:
    """State of the bidiagonalisation: right vectors, short forms of left ones, and the two diagonals."""

    def __init__(self, dims: int, seed: int):
        self.rng = np.random.default_rng(seed)
        self.right = np.zeros((dims, 0))
        self.left = np.zeros((dims, 0))
        self.back = np.zeros((dims, 0))  # At u of each left vector
        self.alpha: list[float] = []
        self.beta: list[float] = []
        self.trace = 0.0
        self.restart()

    def clear(self, x: np.ndarray) -> np.ndarray:
        """``x`` without its part along the right vectors, taken off twice."""
        for _ in range(2):
            x = x - self.right @ (self.right.T @ x)
        return x

    def restart(self) -> None:
        """Go on from a random direction orthogonal to all before."""
        fresh = self.clear(self.rng.standard_normal(len(self.right)))
        self.push(fresh / np.linalg.norm(fresh))

    def push(self, direction: np.ndarray) -> None:
        self.right = np.column_stack([self.right, direction])

    @property
    def steps(self) -> int:
        return len(self.alpha)

    def direction(self) -> np.ndarray:
        """The short ``p`` whose image is the next left vector before it is cleared and scaled."""
        p = self.right[:, -1]
        return p - self.beta[-1] * self.left[:, -1] if self.beta else p

    def take(self, found: np.ndarray) -> None:
        """Add a left vector by the sums of a pass, and the residual that may become the next right one."""
        dims, p = len(self.right), self.direction()
        if not self.steps:
            self.trace = found[1]
        y, along = found[2 : 2 + dims], found[2 + dims :]
        alpha = np.sqrt(max(found[0] - along @ along, 0.0))
        if alpha <= NEGLIGIBLE * np.sqrt(self.trace):
            alpha, w, z = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            w, z = (p - self.left @ along) / alpha, (y - self.back @ along) / alpha
        self.alpha.append(alpha)
        self.left = np.column_stack([self.left, w])
        self.back = np.column_stack([self.back, z])
        self.rest = self.clear(z)
        beta = np.linalg.norm(self.rest)
        self.beta.append(beta if beta > NEGLIGIBLE * np.sqrt(self.trace) else 0.0)

    def advance(self, fresh: bool) -> None:
        """The next right vector: the residual, or a random one if that is negligible or so asked."""
        if fresh or not self.beta[-1]:
            self.beta[-1] = 0.0
            self.restart()
        else:
            self.push(self.rest / self.beta[-1])

    def decompose(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values, right singular vectors, and how far each is from converged."""
        k = self.steps
        small = np.diag(self.alpha) + np.diag(self.beta[: k - 1], 1)
        out, values, turned = np.linalg.svd(small)
        return values, self.right[:, :k] @ turned.T, self.beta[-1] * np.abs(out[-1])


def lanczos(blocks: DataFrame, centre: Centre, wanted: int, seed: int = 0) -> Bidiagonal:
    """Bidiagonalise the centred rows until the ``wanted`` largest directions are settled."""
    dims = len(centre.whole)
    state = Bidiagonal(dims, seed)
    settled, checked_at = None, 0
    while True:
        state.take(_gather(blocks, _products, (centre, state.direction(), state.left)))
        if state.steps == dims or not state.trace:
            return state
        values, _, open_by = state.decompose()
        done = state.steps >= wanted and bool((open_by[:wanted] <= CONVERGED * values[0]).all())
        if settled is not None and state.steps >= checked_at + PROBE:
            if done and np.allclose(values[:wanted], settled, rtol=1e-12, atol=0):
                return state
            settled = None
        probe = done and settled is None
        if probe:
            settled, checked_at = values[:wanted].copy(), state.steps
        state.advance(fresh=probe)


@dataclass
class Whitening:
    """A fitted whitening: ``maps`` takes a centred row to its whitened components."""

    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def maps(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)


def fit_blocks(blocks: DataFrame, dims: int, wanted: int = COMPONENTS, seed: int = 0) -> Whitening | None:
    """The whitening of stored blocks, or None where nothing varies."""
    centre = _exact_centre(blocks, dims)
    if centre is None:
        return None
    state = lanczos(blocks, centre, min(wanted, dims), seed)
    if not state.trace:
        return None
    values, vectors, _ = state.decompose()
    keep = int((values > NEGLIGIBLE * np.sqrt(state.trace)).sum())
    keep = min(keep, wanted)
    eigenvalues = values[:keep] ** 2 / centre.n
    model = Whitening(centre, vectors[:, :keep], eigenvalues, values[:keep] ** 2 / state.trace, 0.0)
    sums = _gather(blocks, _whitened_products, (centre, model.maps))
    mean, second = sums[:keep] / centre.n, sums[keep:].reshape(keep, keep) / centre.n
    model.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(keep)).max())
    return model


_WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double"
)


def _whiten(sent, batches) -> Iterator[pa.RecordBatch]:
    model: Whitening = sent.value
    maps, k = model.maps, len(model.eigenvalues)
    for ids, cells in _cells(batches, len(maps)):
        made = model.centre.centred(cells) @ maps
        rows = len(cells)
        again = pa.array(np.repeat(np.arange(rows), k))
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(again),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.centre.n)),
                pa.array(model.centre.deviations(cells), pa.int64()).take(again),
                pa.array(made.ravel()),
                pa.array(np.tile(model.explained, rows)),
                pa.array(np.full(rows * k, model.identity_error)),
            ],
            ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )


def stored_blocks(vectors: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> tuple[DataFrame, int]:
    """The rows that take part, in blocks in the shared folder, and their number of dimensions."""
    kept = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("vector")
    ).where(finite("vector"))
    lengths = kept.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("rows"))
    dims = lengths.agg(F.max_by("dims", F.struct("rows", "dims"))).first()[0] or 0
    kept = kept.where(F.size("vector") == dims)
    return written(kept.mapInArrow(partial(_to_blocks, scale, dims), _BLOCK), "whitening-blocks"), dims


def whitening_report(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", wanted: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: the whitened value, and what it is judged by."""
    spark = vectors.sparkSession
    blocks, dims = stored_blocks(vectors, id_column, vector_column)
    model = fit_blocks(blocks, dims, wanted) if dims else None
    if model is None:
        return spark.createDataFrame([], _WHITENED)
    return blocks.mapInArrow(partial(_whiten, spark.sparkContext.broadcast(model)), _WHITENED)
