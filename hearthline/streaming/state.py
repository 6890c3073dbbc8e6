"""What a stream's checkpoint tells: open windows, and the watermark of each batch."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hearthline.operators.windows import CITY_MEASURES
from hearthline.sources.files import read_text

# How many numbers an aggregate keeps between batches: an average its sum and count.
_KEPT = {"avg": ("sum", "count"), "sum": ("sum",)}


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    group: str = "city",
    measures: Mapping[str, tuple[str, str]] = CITY_MEASURES,
    batch: int | None = None,
) -> DataFrame:
    """Totals so far of the windows that a ``window_totals`` stream holds in its state, flattened.

    After ``append`` these are the windows that the watermark has not closed, as of the last
    finished batch or an earlier one that is still kept. The state is read partition by partition where
    it lies, while the stream is stopped or running; nothing of the stream changes. The session
    must use the stream's state store provider.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    stored = state.schema["value"].dataType.fields
    names = [f"{name}_{kept}" for name, (how, _) in measures.items() for kept in _KEPT[how]]
    if len(names) != len(stored):
        raise ValueError(f"the state holds {len(stored)} numbers, the measures {len(names)}")
    # Spark names them sum, count, sum, ...: by place they can be told apart.
    renamed = StructType([StructField(name, f.dataType) for name, f in zip(names, stored, strict=True)])

    def total(name: str, how: str):
        if how == "avg":
            return F.try_divide(F.col(f"value.{name}_sum"), F.col(f"value.{name}_count"))
        return F.col(f"value.{name}_sum")

    return state.withColumn("value", F.col("value").cast(renamed)).select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col(f"key.{group}").alias(group),
        *(total(name, how).alias(name) for name, (how, _) in measures.items()),
    )


def batch_watermark(spark: SparkSession, checkpoint: str, number: int) -> int:
    """The watermark under which a batch runs, in epoch milliseconds; 0 before there is one.

    It is in the log of planned batches, which is written before the batch runs, so a
    repeated batch sees the same one.
    """
    planned = read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{number}")
    if planned is None:
        raise FileNotFoundError(f"batch {number} is not planned in {checkpoint}")
    return int(json.loads(planned.split("\n")[1])["batchWatermarkMs"])
