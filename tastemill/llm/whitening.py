"""Whitening of embeddings on principal components found by spectral divide and conquer.

Vectors are turned into integers (the floor of 64 times an entry, plus a million),
and each distinct integer vector is one entry of the fit list, so copies do not
weigh. The list's sums are exact integers; its covariance is added up from
centred entries, which as whole numbers are exact too. A covariance is dims x
dims whatever the number of rows, and its components are found on the driver:

The polar factor of the covariance less a shift has the eigenvalues 1 and -1, so
half of it and the identity projects on the eigenvalues over the shift. The
factor comes from QDWH, a Halley iteration with weights set from a bound of the
least singular value, by QR and later Cholesky factorisations: no inverse, and
about six rounds for any condition. Bases of the two invariant subspaces split
the matrix, and each part is split again, down to single components; parts that
cannot hold one of the wanted components are left as they are.

The components (at most 16 columns of dims numbers) go with the tasks, which
project the rows.

Defined results: rows with a null vector, or a null or infinite entry or NaN, are
dropped; a shorter vector counts as ending in zeros; entries beyond 2^34 count as
2^34; a component of no variance (an eigenvalue under 1e-11 of the largest) is not
returned, so a table with one distinct vector has no rows; a deviation that no
long holds is null; repeated rows are returned each; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import map_batches
from tastemill.session import write_stage

SCALE, SHIFT = 64, 1_000_000
#: Components returned, and the largest entry that is told from larger ones.
COMPONENTS, LARGEST = 16, float(1 << 34)
#: Eigenvalues under this share of the largest count as zero.
_FLAT = 1e-11
_EPS = np.finfo(np.float64).eps


# ---------------------------------------------------------------- polar factor and components


def _weights(low: float) -> tuple[float, float, float]:
    """The Halley weights that are best for singular values between ``low`` and 1."""
    square = low * low
    root = np.cbrt(4 * (1 - square) / (square * square))
    a = np.sqrt(1 + root) + 0.5 * np.sqrt(8 - 4 * root + 8 * (2 - square) / (square * np.sqrt(1 + root)))
    b = (a - 1) ** 2 / 4
    return a, b, a + b - 1


def polar(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    size = len(matrix)
    one = np.eye(size)
    x = matrix / max(float(np.sqrt(np.abs(matrix).sum(0).max() * np.abs(matrix).sum(1).max())), 1e-300)
    # A lower bound of the least singular value, from a triangular factor; too small only costs a round.
    least = np.abs(np.diag(np.linalg.qr(x, mode="r"))).min() / np.sqrt(size)
    low = min(max(0.1 * float(least), _EPS), 1.0)
    for _ in range(30):
        a, b, c = _weights(low) if low < 1 else (3.0, 1.0, 3.0)
        before = x
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))[0]
            x = (b / c) * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        else:
            factor = np.linalg.cholesky(one + c * (x.T @ x))
            half = np.linalg.solve(factor, x.T)
            x = (b / c) * x + (a - b / c) * np.linalg.solve(factor.T, half).T
        low = min(low * (a + b * low * low) / (1 + c * low * low), 1.0)
        x = (x + x.T) / 2
        if 1 - low < 10 * _EPS and np.linalg.norm(x - before) < np.cbrt(_EPS) * np.sqrt(size):
            break
    # One Newton-Schulz step takes the rest of the rounding off.
    x = 1.5 * x - 0.5 * x @ (x.T @ x)
    return (x + x.T) / 2


def _split(matrix: np.ndarray, size_of_all: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the subspaces of the larger and the smaller eigenvalues, or nothing if they are all equal."""
    size = len(matrix)
    middle = np.trace(matrix) / size
    spread = np.linalg.norm(matrix - middle * np.eye(size))
    if spread <= 4 * _EPS * size_of_all * size:
        return None
    diagonal = np.sort(np.diag(matrix))
    tries = [float(np.median(diagonal)), middle]
    # Beside these, shifts on a spread of places; the eigenvalues lie within ``spread`` of the mean.
    tries += [middle + spread * t for t in (0.1, -0.1, 0.03, -0.03, 0.3, -0.3, 0.01, -0.01, 0.003, -0.003, 0.6, -0.6)]
    best = None
    rng = np.random.default_rng(size)
    for shift in tries:
        projector = (polar(matrix - shift * np.eye(size)) + np.eye(size)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < size:
            continue
        basis = np.linalg.qr(projector @ rng.standard_normal((size, rank)))[0]
        for _ in range(2):
            basis = np.linalg.qr(projector @ basis)[0]
        whole = np.linalg.qr(basis, mode="complete")[0]
        upper, lower = whole[:, :rank], whole[:, rank:]
        left = np.linalg.norm(lower.T @ matrix @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 10 * _EPS * size_of_all * np.sqrt(size):
            break
    if best is None:
        return None
    return best[1], best[2]


def components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    ``matrix`` is symmetric. Of every eigenvector the entry of largest size is positive.
    """
    size_of_all = float(np.linalg.norm(matrix))
    found: list[np.ndarray] = []

    def descend(part: np.ndarray, basis: np.ndarray, wanted: int) -> None:
        if wanted <= 0:
            return
        halves = _split(part, size_of_all) if len(part) > 1 else None
        if halves is None:
            found.extend(basis.T[:wanted] if len(part) == 1 else basis.T)
            return
        upper, lower = halves
        for half, more in ((upper, wanted), (lower, wanted - upper.shape[1])):
            inner = half.T @ part @ half
            descend((inner + inner.T) / 2, basis @ half, more)

    descend((matrix + matrix.T) / 2, np.eye(len(matrix)), count)
    vectors = np.array(found).T.reshape(len(matrix), -1)
    vectors = np.linalg.qr(vectors)[0]
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")[:count]
    vectors = vectors[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[order], vectors * np.where(sign == 0, 1, sign)


# ---------------------------------------------------------------- passes over the rows


def integers(vector: Column, size: int | None = None) -> Column:
    """Entries as floor(64 c) + 1,000,000, filled up with zeros to ``size`` entries."""
    clipped = F.transform(
        vector.cast("array<double>"),
        lambda c: F.floor(F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)) * F.lit(float(SCALE))).cast("bigint")
        + F.lit(SHIFT).cast("bigint"),
    )
    if size is None:
        return clipped
    filler = F.array_repeat(F.lit(SHIFT).cast("bigint"), F.greatest(F.lit(size) - F.size(clipped), F.lit(0)))
    return F.concat(clipped, filler)


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null, infinite or NaN."""
    finite = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """A batch of equally long lists as rows of integers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count, total = 0, None
    for batch in batches:
        if batch.num_rows:
            part = _matrix(batch.column(0)).sum(axis=0)
            count, total = count + batch.num_rows, part if total is None else total + part
    if count:
        yield pa.RecordBatch.from_arrays([pa.array([count]), pa.array([total.tolist()])], names=["n", "sums"])


def _added(partial: DataFrame, column: str) -> np.ndarray:
    """Arrays of all tasks added entry by entry: one small row per entry reaches the driver."""
    rows = partial.select(F.posexplode(column).alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    return np.array([r["value"] for r in sorted(rows.collect())])


def _products(moved: np.ndarray, basis: np.ndarray | None, scale: np.ndarray | None):
    """Products of the centred entries of a task's rows, one array per task.

    ``moved`` is taken off each vector first. Without a basis these are whole
    numbers, and exact while they stay under 2^53.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = means = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = (_matrix(batch.column(0)) - moved[0]).astype(np.float64) - moved[1]
            if basis is not None:
                x = (x @ basis) / scale
            part = x.T @ x
            total = part if total is None else total + part
            means = x.sum(axis=0) if means is None else means + x.sum(axis=0)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.append(total.ravel(), means).tolist()])], names=["products"]
            )

    return run


def _covariance(fit: DataFrame, n: int, moved, basis=None, scale=None) -> np.ndarray:
    """Covariance, with divisor ``n``, of the fit list or of what the basis makes of it."""
    partial = map_batches(fit, _products(moved, basis, scale), "products array<double>")
    flat = _added(partial, "products")
    size = int((np.sqrt(1 + 4 * len(flat)) - 1) / 2)
    products, mean = flat[:-size].reshape(size, size) / n, flat[-size:] / n
    # What is left of the mean after centring is at most half a unit, so nothing cancels here.
    return products - np.outer(mean, mean)


class Whitening:
    """Components of a table's vectors; fitted on each distinct vector once."""

    def __init__(self, rows: DataFrame, count: int = COMPONENTS):
        """``rows`` has the integer vectors in column ``x``."""
        self.n, self.values, self.total, self.identity_error = 0, np.empty(0), 0.0, 0.0
        fit = write_stage(rows.select("x").distinct(), "fit-list")
        partial = write_stage(map_batches(fit, _sums, "n bigint, sums array<bigint>"), "fit-sums")
        self.n = partial.agg(F.sum("n").alias("n")).first()["n"] or 0
        self.sums = _added(partial, "sums").astype(np.int64)
        if not len(self.sums):
            return
        # Whole numbers next to the means: what is left are small, exact entries.
        whole = np.array([(2 * int(s) + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)
        matrix = _covariance(fit, self.n, (whole, 0.0))
        self.total = float(np.trace(matrix))
        values, vectors = components(matrix, min(count, len(matrix)))
        kept = values > _FLAT * max(values.max(initial=0.0), 0.0)
        self.values, self.vectors = values[kept], vectors[:, kept]
        if not len(self.values):
            return
        rest = np.array([(int(s) - self.n * int(w)) / self.n for s, w in zip(self.sums, whole)])
        self.centre = whole, rest
        made = _covariance(fit, self.n, self.centre, self.vectors, np.sqrt(self.values))
        self.identity_error = float(np.abs(made - np.eye(len(made))).max())

    def explained(self) -> list[float]:
        return (self.values / self.total).tolist()


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n x - S)^2 over the dimensions, in whole numbers."""
    far = int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0))
    if far < 2**62:
        moved = x * n - sums
        if int(np.abs(moved).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return (moved * moved).sum(axis=1).tolist()
    exact = [sum((int(v) * n - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return [d if d < 2**63 else None for d in exact]


def _project(model: Whitening):
    n, sums, (whole, rest) = model.n, model.sums, model.centre
    basis, scale = model.vectors, np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            made = (((x - whole).astype(np.float64) - rest) @ basis) / scale
            ends = np.arange(len(x) + 1, dtype=np.int32) * made.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(_deviations(x, n, sums), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel())),
                ],
                names=["key", "deviation", "whitened"],
            )

    return run


def vectors_of(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x): the usable vectors as integers, all of one length."""
    kept = table.select(table[key].alias("key"), table[vector].alias("v")).filter(usable(F.col("v")))
    sizes = kept.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    size = sizes["most"] if sizes["least"] != sizes["most"] else None
    return kept.select("key", integers(F.col("v"), size).alias("x"))


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(key, deviation, whitened): each row's components, scaled to unit variance."""
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, deviation bigint, whitened array<double>"
    if not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    return map_batches(rows.select("key", "x"), _project(model), schema)


def whitened_components(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component."""
    rows = vectors_of(table, key, vector)
    model = Whitening(rows)
    shares = F.array(*[F.lit(v) for v in model.explained()]).cast("array<double>")
    made = whiten(rows, model).select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return made.select(
        F.col("key").alias(key),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
