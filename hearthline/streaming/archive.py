"""Raw messages to files by ingest date."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hearthline.functions.event_time import date_parts
from hearthline.functions.payload import marked_messages, pack_marked
from hearthline.scratch import drop, materialize
from hearthline.streaming.queries import for_each_batch

DATE_PARTS = ("year", "month", "day")


def dated_messages(df: DataFrame, ingested: Column | None = None, value: str = "value") -> DataFrame:
    """Message text with its ingest date, by default the UTC date of the micro-batch.

    Line breaks can only stand between JSON tokens, so they become spaces to keep
    one message per line; empty messages are left out.
    """
    text = F.col(value).cast("string")
    broken = F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
    # Few messages hold a line break, and looking for one is far cheaper than replacing.
    line = F.when(broken, F.translate(text, "\r\n", "  ")).otherwise(text)
    if ingested is None:
        ingested = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return df.filter(F.col(value).isNotNull()).select(line.alias("value"), *date_parts(ingested))


def archive_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    ingested: Column | None = None,
) -> StreamingQuery:
    """Append messages below ``path/year=/month=/day=`` exactly once.

    Every micro-batch has folders of its own, named after the checkpoint and its number; one
    that runs again after a failure has the same ingest time and replaces them. No log of the
    sink decides what is read, so streams and batches can share a root, and nothing grows with
    the archive's age. Flush time is the trigger interval, flush size the source's rate cap;
    large batches keep files large.
    """
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def write(batch: DataFrame, number: int) -> None:
        _write(batch, path, f"{stream}-{number}")

    return for_each_batch(
        dated_messages(messages, ingested),
        write,
        checkpoint,
        trigger=trigger or {"processingTime": "10 seconds"},
    )


def archive_batch(messages: DataFrame, path: str, ingested: Column | None = None) -> None:
    """The same tree from a batch. Rebalancing splits a heavy day and packs light ones."""
    dated = dated_messages(messages, ingested).hint("rebalance", *DATE_PARTS)
    _write(dated, path, f"batch-{uuid.uuid4().hex}")


def _write(dated: DataFrame, path: str, name: str) -> None:
    (
        dated.withColumn("part", F.lit(name))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DATE_PARTS, "part")
        .text(path)
    )


def write_array_files(
    messages: DataFrame, path: str, size: int = 10, rejected: str | None = None
) -> None:
    """One JSON array per file, at most ``size`` messages each, for readers of that layout.

    Messages that are not JSON would spoil their file; they go to ``rejected`` as text, and
    without it end the write.
    """
    marked = materialize(marked_messages(messages, size), "marked-messages")
    bad = marked.filter(~F.col("readable")).select("value")
    if rejected is not None:
        bad.write.mode("append").text(rejected)
    elif not bad.isEmpty():
        raise ValueError("some messages are not JSON; name a folder for them")
    pack_marked(marked).write.option("maxRecordsPerFile", 1).mode("append").text(path)
    drop(marked)
