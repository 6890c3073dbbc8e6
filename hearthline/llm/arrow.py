"""Arrow batches in and out of tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function from one batch to dictionaries of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)
