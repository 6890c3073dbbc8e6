"""Late rows go to a table of their own, where windowed totals would drop them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hearthline.schemas import EVENT_TIME
from hearthline.streaming.queries import for_each_batch
from hearthline.streaming.state import batch_watermark


def is_late(time: Column, watermark_millis: int, width_millis: int = 60_000) -> Column:
    """Whether the watermark has passed the end of a row's window. A row without a time is not late.

    In numbers, as the window function itself drops rows without a time.
    """
    end = (F.floor(F.unix_millis(time) / width_millis) + 1) * width_millis
    return F.coalesce(end <= F.lit(watermark_millis), F.lit(False))


def split_late(
    events: DataFrame,
    on_time: str,
    late: str,
    checkpoint: str,
    time: str = EVENT_TIME,
    width_millis: int = 60_000,
    watermark: str = "1 minutes",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Write a stream's rows to two Parquet tables, ``batch=<n>`` folders each; none is lost.

    A row is late if the watermark under which its batch runs has passed its window: the
    greatest event time of the batches before, less the delay. Rows of one batch do not make each
    other late. Totals of the ``on_time`` table are what a stream in append mode gives, and with the
    ``late`` rows they are the totals of all rows. A batch that runs again replaces its folders.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        behind = is_late(F.col(f"`{time}`"), batch_watermark(spark, checkpoint, number), width_millis)
        marked = batch.withColumn("_late", behind)
        # Two filters over one batch: kept, so that it is read and decoded once.
        marked.persist()
        try:
            for path, rows in ((on_time, ~F.col("_late")), (late, F.col("_late"))):
                kept = marked.filter(rows).drop("_late")
                kept.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")
        finally:
            marked.unpersist()

    return for_each_batch(events.withWatermark(time, watermark), write, checkpoint, trigger=trigger)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all finished batches of one of these tables."""
    return spark.read.parquet(path).drop("batch")
