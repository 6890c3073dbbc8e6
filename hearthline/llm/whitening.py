"""Whitening of embeddings by QR of blocks and a bidiagonal qd solver.

Whole-number vectors are summed exactly, centred and reduced to one triangular factor for
each task by blockwise QR; the factors are merged FAN at a time until one is left. Its
squared singular values and right singular vectors (``qd``) are n times the covariance's
eigenvalues, and its eigenvectors: the covariance itself is never formed, so its small
eigenvalues keep their digits. Every row is then projected on the leading directions.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.qd import EPS, right_singular
from hearthline.llm.vectors import dimension, merged_state, task_states, whole_vectors

COMPONENTS = 32
OFFSET = 1_000_000
BLOCK_ROWS = 4096
OUT_ROWS = 1 << 16


class Whitening(NamedTuple):
    n: int
    sums: np.ndarray  # of every dimension, whole numbers
    directions: np.ndarray  # as columns, divided by the square root of their eigenvalue
    explained: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], at: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(first, BLOCK_ROWS)
            rows, x = whole_vectors(part.column(at), size)
            if len(rows):
                if np.abs(x).max() >= 1 << 61:
                    raise OverflowError("a component is too large for a 64-bit whole number")
                yield part, rows, x + OFFSET


def _exact_sums(vectors: DataFrame, size: int) -> tuple[int, list[int], int] | None:
    """Number of usable rows, their sums, and the greatest distance from the offset."""

    def state(batches):
        n, sums, most = 0, [0] * size, 0
        for _, rows, x in _blocks(batches, 0, size):
            n += len(rows)
            largest = int(np.abs(x).max())
            total = x.sum(axis=0) if largest * len(rows) < 1 << 63 else x.astype(object).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, total, strict=True)]
            most = max(most, int(np.abs(x - OFFSET).max()))
        return pickle.dumps((n, sums, most)) if n else None

    def merge(states):
        found = [pickle.loads(s) for s in states]
        return pickle.dumps(
            (sum(f[0] for f in found), [sum(c) for c in zip(*(f[1] for f in found), strict=True)], max(f[2] for f in found))
        )

    merged = merged_state(task_states(vectors, state), merge)
    return pickle.loads(merged) if merged else None


def _numerators(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exactly."""
    return n * (x - OFFSET) - (sums - n * OFFSET)


def _triangle(vectors: DataFrame, size: int, n: int, sums: np.ndarray) -> np.ndarray:
    """R of a QR of all centred rows."""

    def state(batches):
        r = None
        for _, _, x in _blocks(batches, 0, size):
            rows = _numerators(x, n, sums) / n
            r = np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")
        return None if r is None else r.tobytes()

    def merge(states):
        return np.linalg.qr(np.vstack([np.frombuffer(s).reshape(-1, size) for s in states]), mode="r").tobytes()

    r = np.frombuffer(merged_state(task_states(vectors, state), merge)).reshape(-1, size)
    return np.vstack([r, np.zeros((size - len(r), size))])


def fit_whitening(vectors: DataFrame, components: int, vec_col: str) -> Whitening | None:
    """None without a usable row, or if all of them are equal."""
    only = vectors.select(vec_col)
    size = dimension(only, vec_col)
    found = _exact_sums(only, size) if size else None
    if found is None:
        return None
    n, sums, most = found
    if n * most >= 1 << 61:
        raise OverflowError("n times a component passes 64 bits")
    sums = np.array(sums, np.int64)
    values, directions = right_singular(_triangle(only, size, n, sums))
    # What rounding alone can leave of a dimension that depends on others is none.
    rank = int((np.sqrt(values) > 8 * size * EPS * np.sqrt(values[0])).sum()) if values[0] > 0 else 0
    kept = min(components, rank)
    if not kept:
        return None
    return Whitening(n, sums, directions[:, :kept] / np.sqrt(values[:kept] / n), values[:kept] / values.sum())


def _project(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared deviations times n * n, and whitened rows."""
    numerators = _numerators(x, model.n, model.sums)
    rough = (numerators.astype(float) ** 2).sum(axis=1).max()
    if rough < 1 << 62:
        deviation = (numerators * numerators).sum(axis=1)
    else:
        deviation = (numerators.astype(object) ** 2).sum(axis=1)
        if max(deviation) >= 1 << 63:
            raise OverflowError("a deviation passes 64 bits")
        deviation = deviation.astype(np.int64)
    return deviation, (numerators / model.n) @ model.directions


def identity_error(vectors: DataFrame, model: Whitening, vec_col: str) -> float:
    """Largest entry of the whitened rows' covariance less the identity."""
    size, k = model.directions.shape

    def state(batches):
        found = []
        for _, rows, x in _blocks(batches, 0, size):
            y = _project(model, x)[1]
            mean = y.mean(axis=0)
            found.append(pickle.dumps((len(rows), mean, (y - mean).T @ (y - mean))))
            if len(found) == 64:
                found = [merge(found)]
        return merge(found) if found else None

    def merge(states):
        found = [pickle.loads(s) for s in states]
        n = sum(f[0] for f in found)
        mean = sum(f[0] * f[1] for f in found) / n
        squares = sum(f[2] + f[0] * np.outer(f[1] - mean, f[1] - mean) for f in found)
        return pickle.dumps((n, mean, squares))

    n, _, squares = pickle.loads(merged_state(task_states(vectors.select(vec_col), state), merge))
    return float(np.abs(squares / n - np.eye(k)).max())


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Every usable row on each leading component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A component c counts as floor(64 * c) + 1000000. Null vectors, vectors that hold a null or
    a number that is not finite, and vectors of another length than the most frequent one (of
    equally frequent ones the greatest) take no part; neither does an empty vector. Rows that
    repeat, or have no id, each count and each get their rows. Components are numbered from 1
    by falling eigenvalue; directions in which the rows do not differ (beyond rounding) are
    left out, so a single row, or equal ones, give no rows, as an empty table does. Numbers that
    64 bits cannot hold end the job. Other columns are not read. The driver and every task hold
    some d * d numbers for d dimensions, and FAN such triangles while they are merged.
    """
    kind = dict(vectors.dtypes)[id_col]
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    model = fit_whitening(vectors, components, vec_col)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size, k = model.directions.shape
    error = identity_error(vectors, model, vec_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, OUT_ROWS // k)
        for part, rows, x in _blocks(batches, 1, size):
            for first in range(0, len(rows), step):
                deviation, y = _project(model, x[first : first + step])
                m = len(y)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": part.column(0).take(pa.array(np.repeat(rows[first : first + step], k))),
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                        "n": np.full(m * k, model.n, np.int64),
                        "deviation": np.repeat(deviation, k),
                        "whitened": y.ravel(),
                        "explained": np.tile(model.explained, m),
                        "identity_error": np.full(m * k, error),
                    }
                )

    return vectors.select(F.col(id_col), F.col(vec_col)).mapInArrow(run, schema)
