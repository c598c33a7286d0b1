import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastemill.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, key string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "k", "x") for i, v in rows], SCHEMA)


def whole(vector, size):
    return tuple(math.floor(64 * c) + 1_000_000 for c in list(vector) + [0.0] * (size - len(vector)))


def check(spark, rows):
    """Against numpy's own eigenvectors and plain integer sums."""
    kept = [
        (i, [float(c) for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(np.float32(c)) for c in v)
    ]
    kept = [(i, [float(np.float32(c)) for c in v]) for i, v in kept]
    size = max((len(v) for _, v in kept), default=0)
    fit = sorted({whole(v, size) for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    cov = x.T @ x / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = int((values > 1e-11 * values[0]).sum())
    found = {}
    out = whitening.whitened_components(frame(spark, rows)).collect()
    for r in out:
        found.setdefault(r.vec_id, []).append(r)
    assert len(out) == len(kept) * min(count, 16)
    for i, v in kept:
        moved = [n * c - s for c, s in zip(whole(v, size), sums)]
        mine = sorted(found[i], key=lambda r: r.component)
        assert {r.deviation for r in mine} == {sum(m * m for m in moved)} and {r.n for r in mine} == {n}
        assert max(r.identity_error for r in mine) < 1e-8
        for r in mine:
            k = r.component - 1
            assert abs(r.explained - values[k] / values.sum()) <= 1e-9 * r.explained + 1e-14
    made = {i: [r.whitened for r in sorted(rs, key=lambda r: r.component)] for i, rs in found.items()}
    for k in range(min(count, 16)):
        gaps = np.abs(np.delete(values, k) - values[k])
        if gaps.min(initial=1) < 1e-6 * values[0]:
            continue
        want = {i: np.dot([(n * c - s) / n for c, s in zip(whole(v, size), sums)], vectors[:, k]) for i, v in kept}
        sign = np.sign(sum(want[i] * made[i][k] for i, _ in kept))
        for i, _ in kept:
            assert abs(sign * want[i] / math.sqrt(values[k]) - made[i][k]) < 1e-6
    return out


def test_random_vectors_with_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(24) * np.linspace(0.1, 2, 24)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]
    assert len({r.component for r in check(spark, rows)}) == 16


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(20)]
    odd = [None, [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [0.0, float("inf"), 0.0], [-float("inf"), 0.0, 0.0]]
    rows += [(100 + i, v) for i, v in enumerate(odd)] + [(200, [0.5]), (201, []), (202, [0.25, -1.0])]
    rows += [(203, rows[0][1])]
    check(spark, rows)


def test_few_or_equal_vectors_have_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]):
        assert whitening.whitened_components(frame(spark, rows)).count() == 0


def test_fewer_directions_than_dimensions(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, -float(i)]) for i in range(40)]
    assert {r.component for r in check(spark, rows)} == {1}


def test_entries_of_any_size(spark):
    rows = [(i, [float(i), 3e38 if i == 5 else 1e7 * i, -1e30 if i == 6 else 0.0]) for i in range(10)]
    out = whitening.whitened_components(frame(spark, rows)).collect()
    assert {r.vec_id for r in out} == set(range(10)) and all(math.isfinite(r.whitened) for r in out)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 10**6), st.sampled_from(["full", "flat", "equal", "cluster"]))
def test_components_are_eigenvectors(size, seed, kind):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    values = {
        "full": 10.0 ** rng.uniform(-8, 3, size),
        "flat": np.where(np.arange(size) < max(1, size // 3), rng.uniform(1, 2, size), 0.0),
        "equal": np.full(size, 5.0),
        "cluster": rng.choice([1.0, 1.0 + 1e-9, 50.0], size),
    }[kind]
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    count = min(size, 16)
    found, vectors = whitening.components(matrix, count)
    norm = np.linalg.norm(matrix)
    assert np.abs(found - np.sort(np.linalg.eigvalsh(matrix))[::-1][:count]).max() < 1e-13 * norm
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * norm
    assert np.abs(vectors.T @ vectors - np.eye(count)).max() < 1e-13


@pytest.mark.parametrize("size", [1, 2, 30])
def test_polar_factor(size):
    rng = np.random.default_rng(size)
    matrix = rng.standard_normal((size, size))
    matrix += matrix.T
    factor = whitening.polar(matrix)
    assert np.abs(factor @ factor - np.eye(size)).max() < 1e-13
    assert np.linalg.eigvalsh(factor @ matrix).min() > -1e-12
