"""Whitening and hard negatives against dense and brute-force versions."""

import math
import random

import numpy as np
import pytest

from statledger.llm import negatives, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int, row bigint, component int, score string"


@pytest.fixture(scope="module")
def make_vectors(ready):
    def made(rows):
        return ready.createDataFrame([(*r, 3, 4, "x") for r in rows], VECTORS).repartition(3)

    return made


def random_rows(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    cells = (rng.standard_normal((n, dims)) * np.linspace(spread, 0.2, dims)).astype(np.float32)
    return [(k, row.tolist(), int(rng.integers(0, 4))) for k, row in enumerate(cells)]


ODD = [
    (900, None, 1),
    (901, [1.0, None, 2.0], 1),
    (902, [1.0, float("nan"), 2.0], 1),
    (903, [1.0, float("inf"), 2.0], 1),
]


# -- whitening -------------------------------------------------------------------------


def plain_whitening(rows):
    """Whole cells, exact deviations, eigenvalues and eigenvectors by falling eigenvalue."""
    cells = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in rows])
    n, sums = len(cells), cells.sum(axis=0)
    deviations = [sum(int(d) ** 2 for d in n * x - sums) for x in cells]
    centred = (n * cells - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return centred, deviations, values[::-1], vectors[:, ::-1]


def table_of(report):
    found = {}
    for r in report.collect():
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    return found


@pytest.mark.parametrize("dims", [3, 34])
def test_whitening_equals_dense_eigenvectors(make_vectors, dims):
    rows = random_rows(300, dims, seed=dims)
    found = table_of(whitening.whitening_report(make_vectors(rows + ODD)))
    centred, deviations, values, vectors = plain_whitening(rows)
    wanted = min(32, dims)
    assert sorted(found) == [k for k, _, _ in rows]
    assert all(sorted(f) == list(range(1, wanted + 1)) for f in found.values())
    assert [found[k][1]["deviation"] for k, _, _ in rows] == deviations
    made = np.array([[found[k][c]["whitened"] for c in range(1, wanted + 1)] for k, _, _ in rows])
    expected = centred @ vectors[:, :wanted] / np.sqrt(values[:wanted])
    signs = np.sign((made * expected).sum(axis=0))
    assert np.abs(made - expected * signs).max() < 1e-10
    explained = np.array([found[0][c]["explained"] for c in range(1, wanted + 1)])
    assert np.allclose(explained, values[:wanted] / values.sum(), rtol=1e-12)
    assert {r["n"] for f in found.values() for r in f.values()} == {300}
    errors = {r["identity_error"] for f in found.values() for r in f.values()}
    assert len(errors) == 1 and errors.pop() < 1e-12


def test_both_sides_stay_orthogonal(make_vectors):
    rows = random_rows(400, 12, seed=5, spread=300.0)
    blocks, dims = whitening.stored_blocks(make_vectors(rows), "vec_id", "embedding")
    centre = whitening._exact_centre(blocks, dims)
    state = whitening.lanczos(blocks, centre, dims)
    centred = plain_whitening(rows)[0]
    left = centred @ state.left
    assert np.abs(state.right.T @ state.right - np.eye(dims)).max() < 1e-13
    assert np.abs(left.T @ left - np.eye(dims)).max() < 1e-9
    small = np.diag(state.alpha) + np.diag(state.beta[: dims - 1], 1)
    assert np.abs(centred @ state.right - left @ small).max() < 1e-7


def test_equal_and_zero_eigenvalues(make_vectors):
    """Four equal eigenvalues, one direction without variance and a repeated dimension."""
    rows = []
    for k in range(64):
        signs = [1.0 if k >> j & 1 else -1.0 for j in range(4)]
        rows.append((k, [*signs, 7.0, signs[0]], 0))
    found = table_of(whitening.whitening_report(make_vectors(rows)))
    assert {len(f) for f in found.values()} == {4}
    explained = [found[0][c]["explained"] for c in range(1, 5)]
    assert np.allclose(explained, [0.4, 0.2, 0.2, 0.2], rtol=1e-9)
    assert found[0][1]["identity_error"] < 1e-10


def test_many_dimensions_stop_early(make_vectors):
    rng = np.random.default_rng(3)
    loads = rng.standard_normal((3, 70)) * 40
    rows = [(k, (rng.standard_normal(3) @ loads + rng.standard_normal(70) * 0.1).tolist(), 0) for k in range(200)]
    df = make_vectors(rows)
    blocks, dims = whitening.stored_blocks(df, "vec_id", "embedding")
    centre = whitening._exact_centre(blocks, dims)
    state = whitening.lanczos(blocks, centre, 2)
    assert state.steps < dims
    values = state.decompose()[0][:2] ** 2 / centre.n
    expected = plain_whitening([r.asDict().values() for r in df.select("vec_id", "embedding", "label").collect()])[2]
    assert np.allclose(values, expected[:2], rtol=1e-11)


@pytest.mark.parametrize("rows", [[], ODD, [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 4, [(1, [], 0)] * 2])
def test_nothing_varies(make_vectors, rows):
    assert whitening.whitening_report(make_vectors(rows)).collect() == []


def test_large_entries_and_other_lengths(make_vectors):
    rows = [(k, [float(k) * 1e15, float(k % 3)], 0) for k in range(30)] + [(None, [1e15, 1.0], 0), (99, [1.0], 0)]
    found = table_of(whitening.whitening_report(make_vectors(rows)))
    assert set(found) == {None, *range(30)}
    assert {r["deviation"] for f in found.values() for r in f.values()} == {None}


# -- hard negatives --------------------------------------------------------------------


def plain_negatives(rows):
    kept = [
        (i, [math.floor(256 * c) for c in v], label)
        for i, v, label in rows
        if label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    order = lambda entry: (-entry[0], entry[1] is None, entry[1] or 0)
    out = []
    for k, (anchor, own, label) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = [
            (sum(a * b for a, b in zip(own, v)), i, other)
            for j, (i, v, other) in enumerate(kept)
            if j != k
        ]
        positives = sorted([s for s in scored if s[2] == label], key=order)[:5]
        for p, positive, _ in positives:
            near = sorted([s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p], key=order)[:5]
            out += [(anchor, positive, r, i, p, s) for r, (s, i, _) in enumerate(near, 1)]
    return sorted(out, key=repr)


def mined(df):
    return sorted(map(tuple, negatives.hard_negatives(df).collect()), key=repr)


@pytest.mark.parametrize("largest", [3, 300, 1 << 20, 1 << 45])
def test_packed_scores_are_exact(largest):
    rng = random.Random(largest)
    a, b = ([[rng.randint(-largest, largest) for _ in range(17)] for _ in range(n)] for n in (5, 11))
    expected = [[sum(x * y for x, y in zip(p, q)) for q in b] for p in a]
    cut = [[min(max(s, negatives.LOW + 1), negatives.HIGH) for s in row] for row in expected]
    assert negatives.packed_scores(np.array(a), np.array(b)).tolist() == cut


def test_negatives_of_random_rows(make_vectors):
    rows = [(25 * k, *r[1:]) for k, r in enumerate(random_rows(400, 8, seed=2))]
    assert mined(make_vectors(rows + ODD)) == plain_negatives(rows) != []


def test_ties_copies_null_ids_and_a_hot_label(make_vectors):
    rng = random.Random(8)
    rows = [(k, [float(rng.randrange(3)) for _ in range(4)], 1 if k % 3 else k % 5) for k in range(300)]
    rows += [(100, [1.0, 1.0, 0.0, 2.0], 1)] * 3 + [(None, [2.0, 2.0, 2.0, 2.0], c) for c in (1, 2, 2)]
    rows += [(5, [1.0, 1.0], 1), (6, [2.0], 3), (7, [], 1), (8, [1.0] * 4, None)]
    assert mined(make_vectors(rows)) == plain_negatives(rows) != []


def test_several_groups_and_blocks(make_vectors, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", 3)
    monkeypatch.setattr(negatives, "CHUNK", 2)
    rows = [(10 * k, *r[1:]) for k, r in enumerate(random_rows(150, 5, seed=9))]
    assert mined(make_vectors(rows)) == plain_negatives(rows) != []


@pytest.mark.parametrize("rows", [[], ODD, [(100, [1.0], 0)], [(100, [1.0], 0), (101, [-1.0], 0)]])
def test_no_negatives(make_vectors, rows):
    assert mined(make_vectors(rows)) == []


def test_shifted_labels(make_vectors):
    rows = [(7, [1.0], 9), (8, [1.0], 9), (14, [1.0], None), (None, [1.0], 2)]
    found = {r["vec_id"]: r["label"] for r in negatives.shifted_labels(make_vectors(rows)).collect()}
    assert found == {7: 0, 8: 9, 14: None, None: 2}
