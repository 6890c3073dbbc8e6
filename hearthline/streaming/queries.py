"""Start, drain and await streaming queries."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hearthline.functions.payload import parse_events
from hearthline.operators.keyed_table import KeyedTable
from hearthline.operators.merge_table import MergeTable
from hearthline.operators.windows import CITY_FIELDS, window_totals


def city_totals(messages: DataFrame, unit: str = "ms", fractional: bool = False) -> DataFrame:
    """Messages to per-minute totals per city; decodes only the fields these need."""
    return window_totals(parse_events(messages, CITY_FIELDS, unit, fractional))


def start_query(
    df: DataFrame,
    checkpoint: str,
    fmt: str = "console",
    output_mode: str = "complete",
    trigger: Mapping[str, object] | None = None,
    options: Mapping[str, str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query on its own checkpoint.

    ``complete`` sends the whole result each time and keeps every window for ever,
    late rows included. ``append`` and ``update`` drop rows older than the watermark
    and forget closed windows, so their state stays bounded: use them at volume.
    """
    settings = {"truncate": "false"} if fmt == "console" else {}
    writer = (
        df.writeStream.format(fmt)
        .outputMode(output_mode)
        .options(**{**settings, **(options or {})})
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def for_each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``write``, which may see one again after a restart."""
    writer = (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def upsert_stream(
    df: DataFrame,
    table: KeyedTable,
    order: Sequence[str],
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Merge every micro-batch into the keyed table; a repeated batch changes nothing."""
    return for_each_batch(
        df, lambda batch, _: table.upsert(batch, order), checkpoint, trigger=trigger
    )


def merge_stream(
    df: DataFrame,
    table: MergeTable,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append every micro-batch to a table that merges on read, each exactly once.

    The table knows the stream by its checkpoint and the last batch it has taken.
    """
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()

    def write(batch: DataFrame, number: int) -> None:
        table.upsert(batch, stream, number)

    return for_each_batch(df, write, checkpoint, trigger=trigger)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; its failure is raised here."""
    query.awaitTermination()
    return query


def await_any(queries: Iterable[StreamingQuery], poll: float = 1.0) -> None:
    """Block until one of these queries ends, then stop the others; its failure is raised here."""
    queries = list(queries)
    try:
        # Each wait ends at once if its query has; the session's other queries don't count.
        while queries and not any(query.awaitTermination(poll / len(queries)) for query in queries):
            pass
    finally:
        for query in queries:
            query.stop()
