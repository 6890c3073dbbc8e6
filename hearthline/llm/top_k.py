"""Exact top-k inner products by a pivot-distance index.

Inner products become distances: with one more coordinate, sqrt(M * M - |x|^2), every vector
has the length M of the longest one, and the nearest vectors to (q, 0) are those of the largest
inner product. Vectors are sorted by (nearest pivot, distance from it) and cut into annuli. The
scores within a query's own part of the index give its first bound; then annuli are visited by
the least distance that the triangle inequality allows, and left out once that is beyond the
bound. Annuli are grouped in chunks, queries in groups; a chunk and a group meet in one
task only if some annulus may matter to some query.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.vectors import dimension, whole_vectors
from hearthline.scratch import materialize

K = 20
PIVOTS, SAMPLE, ROUNDS = 32, 4096, 8  # pivots are the means of a sample, refined so often
ANNULUS_ROWS, CHUNK_ROWS = 4096, 8192
QUERY_CHUNKS = 32  # queries of so many neighbouring chunks go together
NONE = -(1 << 63)  # a query's bound before it has k scores


class Space(NamedTuple):
    """What all vectors share."""

    size: int
    longest: int  # largest squared length
    kind: str  # numpy's name of the smallest whole numbers that hold all components
    pivots: np.ndarray  # with the additional coordinate

    @property
    def slack(self) -> float:
        return 1e-6 * (1 + float(self.longest) ** 0.5)

    def lifted(self, squares: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, float(self.longest) - squares))

    def pivot_distances(self, x: np.ndarray, extra: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """Of rows with the additional coordinate ``extra`` and the squared length ``squares``, that included."""
        inner = x.astype(float) @ self.pivots[:, :-1].T + extra[:, None] * self.pivots[:, -1]
        found = squares[:, None] + (self.pivots**2).sum(axis=1) - 2 * inner
        return np.sqrt(np.maximum(0.0, found))

    def products(self, queries: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Inner products, exactly: no partial sum is larger than the product of the lengths."""
        if self.longest < 1 << 24:
            return (queries.astype(np.float32) @ x.astype(np.float32).T).astype(np.int64)
        if self.longest < 1 << 53:
            return (queries.astype(float) @ x.astype(float).T).astype(np.int64)
        return queries.astype(np.int64) @ x.astype(np.int64).T

    def matrix(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.kind).reshape(-1, self.size)

    def reach(self, query_squares: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Distance beyond which a score is below ``bound``."""
        far = np.sqrt(np.maximum(0.0, query_squares + float(self.longest) - 2.0 * bound)) + self.slack
        return np.where(bound == NONE, np.inf, far)


def _means(sample: np.ndarray, n: int) -> np.ndarray:
    """Some rounds of k-means from rows spread over the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int)].astype(float)
    for _ in range(ROUNDS):
        far = (centres**2).sum(axis=1) - 2 * sample @ centres.T
        nearest = far.argmin(axis=1)
        for i in range(len(centres)):
            if (nearest == i).any():
                centres[i] = sample[nearest == i].mean(axis=0)
    return centres


def describe(vectors: DataFrame, id_col: str, vec_col: str, pivots: int, sample: int) -> tuple[Space, int] | None:
    """The space and the number of usable vectors; None without one. ``sample`` rows at most reach the driver."""
    size = dimension(vectors, vec_col)
    if size is None:
        return None

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = whole_vectors(batch.column(0), size)
            if len(rows):
                most = int(np.abs(x).max())
                if size * most * most >= 1 << 62:
                    raise OverflowError("an inner product may pass 64 bits")
                found = {"n": [len(rows)], "longest": [int((x * x).sum(axis=1).max())], "most": [most]}
                yield pa.RecordBatch.from_pydict(found)

    measured = vectors.select(vec_col).mapInArrow(measure, "n long, longest long, most long")
    n, longest, most = measured.agg(F.sum("n"), F.max("longest"), F.max("most")).first()
    if not n:
        return None
    kind = next(k for k in ("int8", "int16", "int32", "int64") if most <= np.iinfo(k).max)
    hashed = vectors.filter(F.size(vec_col) == size).select(vec_col, F.xxhash64(id_col, vec_col).alias("h"))
    drawn = hashed.orderBy("h").limit(sample).collect()
    rows, x = whole_vectors(pa.array([r[0] for r in drawn], pa.list_(pa.float64())), size)
    x = x.astype(float)
    extra = np.sqrt(np.maximum(0.0, longest - (x * x).sum(axis=1)))
    # A sample without a usable row leaves the origin as the only pivot.
    lifted = np.column_stack([x, extra]) if len(rows) else np.zeros((1, size + 1))
    return Space(size, longest, kind, _means(lifted, pivots)), n


def _keyed(vectors: DataFrame, space: Space) -> DataFrame:
    """Rows of (vec_id, is_query, row, vector) with their pivot and distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = whole_vectors(batch.column(3), space.size)
            if not len(rows):
                continue
            squares = (x * x).sum(axis=1)
            far = space.pivot_distances(x, space.lifted(squares), np.full(len(x), float(space.longest)))
            pivot = far.argmin(axis=1)
            small = np.ascontiguousarray(x.astype(space.kind))
            take = pa.array(rows)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column(0).take(take),
                    "is_query": batch.column(1).take(take),
                    "row": batch.column(2).take(take),
                    "pivot": pivot.astype(np.int32),
                    "distance": far[np.arange(len(x)), pivot],
                    "vec": pa.array([v.tobytes() for v in small], pa.binary()),
                }
            )

    return vectors.mapInArrow(run, "vec_id long, is_query boolean, row long, pivot int, distance double, vec binary")


_INDEX = (
    "chunk long, pivot int, low double, high double, ids array<long>, rows array<long>, vecs binary, "
    "query_ids array<long>, query_rows array<long>, query_vecs binary, bounds array<long>"
)


def build_index(vectors: DataFrame, space: Space, n: int, k: int, annulus_rows: int, chunk_rows: int) -> DataFrame:
    """Annuli, each with its vectors and the queries among them with their first bound."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId()
        for batch in batches:
            pivot = batch.column(3).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(pivot)) + 1).tolist(), len(pivot)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for first in range(a, b, annulus_rows):
                    part = batch.slice(first, min(annulus_rows, b - first))
                    data = b"".join(part.column(5).to_pylist())
                    x = space.matrix(data)
                    asks = np.flatnonzero(part.column(1).to_numpy(zero_copy_only=False))
                    bounds = np.full(len(asks), NONE)
                    for at in range(0, len(asks), 1024):
                        some = asks[at : at + 1024]
                        scores = space.products(x[some], x)
                        scores[np.arange(len(some)), some] = NONE
                        if len(x) > k:
                            bounds[at : at + 1024] = np.partition(scores, len(x) - k, axis=1)[:, len(x) - k]
                    far = part.column(4).to_numpy()
                    taken = pa.array(asks)
                    row = {
                        "chunk": pa.array([chunk], pa.int64()),
                        "pivot": pa.array([int(pivot[first])], pa.int32()),
                        "low": [float(far[0])],
                        "high": [float(far[-1])],
                        "ids": pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        "rows": pa.array([part.column(2).to_pylist()], pa.list_(pa.int64())),
                        "vecs": pa.array([data], pa.binary()),
                        "query_ids": pa.array([part.column(0).take(taken).to_pylist()], pa.list_(pa.int64())),
                        "query_rows": pa.array([part.column(2).take(taken).to_pylist()], pa.list_(pa.int64())),
                        "query_vecs": pa.array([x[asks].tobytes()], pa.binary()),
                        "bounds": pa.array([bounds], pa.list_(pa.int64())),
                    }
                    yield pa.RecordBatch.from_pydict(row)

    order = ("pivot", "distance", "row")
    sorted_rows = _keyed(vectors, space).repartitionByRange(-(-n // chunk_rows), *order).sortWithinPartitions(*order)
    return materialize(sorted_rows.mapInArrow(pack, _INDEX), "top-k-index")


def _query_bounds(space: Space, q: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of queries to the pivots, and their reach."""
    squares = (q.astype(np.int64) ** 2).sum(axis=1).astype(float)
    return space.pivot_distances(q, np.zeros(len(q)), squares), space.reach(squares, bound)


def _meetings(index: DataFrame, space: Space, query_chunks: int) -> DataFrame:
    """Which group of queries has to see which chunk: query_group, chunk."""

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, data, bounds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                q = space.matrix(data)
                far, reach = _query_bounds(space, q, np.array(bounds, np.int64))
                # A vector nearest to another pivot is at least half the difference away.
                may = (far - far.min(axis=1, keepdims=True)) / 2 <= reach[:, None]
                low = np.where(may, far - reach[:, None], np.inf).min(axis=0)
                high = np.where(may, far + reach[:, None], -np.inf).max(axis=0)
                some = np.flatnonzero(may.any(axis=0))
                found = {"query_group": np.full(len(some), group), "pivot": some.astype(np.int32), "first": low[some]}
                yield pa.RecordBatch.from_pydict({**found, "last": high[some]})

    group = F.floor(F.col("chunk") / query_chunks).alias("query_group")
    asked = index.filter(F.size("query_rows") > 0).select(group, "query_vecs", "bounds")
    wanted = asked.mapInArrow(needs, "query_group long, pivot int, first double, last double")
    ranges = wanted.groupBy("query_group", "pivot").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    annuli = index.select("chunk", "pivot", "low", "high")
    met = ranges.join(annuli, "pivot").filter("high >= first AND low <= last")
    return materialize(met.select("query_group", "chunk").distinct(), "top-k-meetings")


def _best(of, score, rows, ids, known, k):
    """The k best of each query: by score, then known ids rising, then rows."""
    order = np.lexsort((rows, ids, ~known, -score, of))
    of = of[order]
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, int)
    rank = np.arange(len(of)) - np.repeat(starts, np.diff(np.r_[starts, len(of)]))
    kept = order[rank < k]
    return kept, of[rank < k], rank[rank < k]


_FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def _search(space: Space, k: int, annuli: pa.Table, asked: pa.Table) -> pa.Table:
    """The k best vectors of a chunk for every query of a group, as far as they reach its bound."""
    empty = pa.array([], pa.int64())
    if not annuli.num_rows or not asked.num_rows:
        return pa.table(dict.fromkeys(("query_row", "query_id", "row", "vec_id", "score"), empty))
    annuli, asked = annuli.combine_chunks(), asked.combine_chunks()
    q = np.concatenate([space.matrix(v) for v in asked.column("query_vecs").to_pylist()])
    flat = lambda name: np.array([x for part in asked.column(name).to_pylist() for x in part], np.int64)
    query_rows, query_ids, bound = flat("query_rows"), flat("query_ids"), flat("bounds")
    far, reach = _query_bounds(space, q, bound)
    pivot = annuli.column("pivot").to_numpy()
    low, high = annuli.column("low").to_numpy(), annuli.column("high").to_numpy()
    least = np.maximum(np.maximum(low - far[:, pivot], far[:, pivot] - high), (far[:, pivot] - far.min(axis=1)[:, None]) / 2)
    squares = (q.astype(np.int64) ** 2).sum(axis=1).astype(float)
    # Of every query its best rows so far; a null id is kept apart.
    of, score, rows, ids = (np.zeros(0, np.int64) for _ in range(4))
    known = np.zeros(0, bool)
    for a in np.argsort(least.min(axis=0), kind="stable"):
        near = np.flatnonzero(least[:, a] <= reach)
        if not len(near):
            continue
        x = space.matrix(annuli.column("vecs")[int(a)].as_py())
        its_rows = annuli.column("rows")[int(a)].values.to_numpy(zero_copy_only=False)
        its_ids = annuli.column("ids")[int(a)].values
        its_known = its_ids.is_valid().to_numpy(zero_copy_only=False)
        its_ids = its_ids.fill_null(0).to_numpy(zero_copy_only=False)
        step = max(1, (1 << 22) // len(x))
        new = []
        for first in range(0, len(near), step):
            some = near[first : first + step]
            found = space.products(q[some], x)
            i, j = np.nonzero(found >= bound[some][:, None])
            other = its_rows[j] != query_rows[some[i]]
            i, j = i[other], j[other]
            kept, _, _ = _best(some[i], found[i, j], its_rows[j], its_ids[j], its_known[j], k)
            i, j = i[kept], j[kept]
            new.append((some[i], found[i, j], its_rows[j], its_ids[j], its_known[j]))
        of, score, rows, ids, known = (
            np.concatenate([old, *(n[c] for n in new)]) for c, old in enumerate((of, score, rows, ids, known))
        )
        kept, owner, rank = _best(of, score, rows, ids, known, k)
        of, score, rows, ids, known = of[kept], score[kept], rows[kept], ids[kept], known[kept]
        last = rank == k - 1
        bound[owner[last]] = np.maximum(bound[owner[last]], score[last])
        reach = space.reach(squares, bound)
    return pa.table(
        {
            "query_row": query_rows[of],
            "query_id": query_ids[of],
            "row": rows,
            "vec_id": pa.array(ids, pa.int64(), mask=~known),
            "score": score,
        }
    )


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    pivots: int = PIVOTS,
    sample: int = SAMPLE,
    annulus_rows: int = ANNULUS_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    query_chunks: int = QUERY_CHUNKS,
) -> DataFrame:
    """The k rows with the largest inner product for every row where ``is_query`` holds: query_id, rank, vec_id, score.

    A component x counts as floor(64 * x). Ids are whole numbers. A row is never found for
    itself, but another row with its id or vector is. Ties go to the smaller id, rows without an id
    last, then to the earlier row. Rows with a null ``is_query`` do not ask. Null vectors, vectors that
    hold a null or a number that is not finite, and vectors of another length than the most frequent
    one (of equally frequent ones the greatest) take no part. An empty table gives no rows; fewer than
    k others give all of them. Numbers whose products 64 bits cannot hold end the job. Other
    columns are not read. The sample fits the pivots only: every vector is indexed, every
    annulus that the bound does not exclude is searched. A task holds one chunk and one group of
    queries; larger chunks send fewer copies of both.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    found = describe(vectors.select(id_col, vec_col), id_col, vec_col, pivots, sample)
    if found is None:
        return spark.createDataFrame([], schema)
    space, n = found
    asks = F.coalesce(is_query, F.lit(False)) & F.col(id_col).isNotNull()
    rows = vectors.select(F.col(id_col).cast("long"), asks, F.monotonically_increasing_id(), F.col(vec_col))
    index = build_index(rows, space, n, k, annulus_rows, chunk_rows)
    met = _meetings(index, space, query_chunks)
    group = F.floor(F.col("chunk") / query_chunks).alias("query_group")
    asked = index.filter(F.size("query_rows") > 0)
    asked = asked.select(group, "query_ids", "query_rows", "query_vecs", "bounds").join(met, "query_group")
    annuli = index.select("chunk", "pivot", "low", "high", "ids", "rows", "vecs").join(met, "chunk")
    cells = annuli.groupBy("chunk", "query_group").cogroup(asked.groupBy("chunk", "query_group"))
    best = cells.applyInArrow(lambda left, right: _search(space, k, left, right), _FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
