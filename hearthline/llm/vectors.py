"""Embeddings as whole numbers, floor(64 * x) of every component, and states merged over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.scratch import drop, materialize

SCALE = 64
FAN = 32  # states that one task or the driver merges at once


def dimension(vectors: DataFrame, vec_col: str) -> int | None:
    """The most frequent length, the greater of two; None if there is no vector."""
    lengths = vectors.filter(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("size"))
    found = lengths.count().filter("size > 0").orderBy(F.desc("count"), F.desc("size")).first()
    return found["size"] if found else None


def whole_vectors(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a usable vector (not null, ``size`` finite numbers), and these as whole numbers."""
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == size)
    flat = column.take(pa.array(rows, pa.int64())).flatten().cast(pa.float64())
    found = flat.to_numpy(zero_copy_only=False).reshape(-1, size)  # a null becomes NaN
    finite = np.isfinite(found).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * found[finite])
    if scaled.size and not np.abs(scaled).max() < 1 << 62:
        raise OverflowError("a component is too large for a 64-bit whole number")
    return rows[finite], scaled.astype(np.int64)


def task_states(df: DataFrame, state: Callable[[Iterator[pa.RecordBatch]], bytes | None]) -> DataFrame:
    """One state for each task: ``part``, ``state``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = state(batches)
        if found is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "state": pa.array([found], pa.binary())})

    return df.mapInArrow(run, "part long, state binary")


def merged_state(states: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """All states in one, FAN of them in a task; the driver takes the last FAN."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        found = merge(table.column("state").to_pylist())
        return pa.table({"part": table.column("part").slice(0, 1), "state": pa.array([found], pa.binary())})

    written = materialize(states, "states")
    while (n := written.count()) > FAN:
        dealt = written.withColumn("group", F.col("part") % F.lit(-(-n // FAN)))
        smaller = dealt.groupBy("group").applyInArrow(
            lambda table: run(table.select(["part", "state"])), "part long, state binary"
        )
        fewer = materialize(smaller, "states")
        drop(written)
        written = fewer
    found = [bytes(row["state"]) for row in written.orderBy("part").collect()]
    drop(written)
    return merge(found) if found else None
