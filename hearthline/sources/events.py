"""Message sources: a Kafka topic, or a folder of files carrying the same payload."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

MESSAGE_SCHEMA = StructType([StructField("value", StringType())])


def kafka_options(brokers: str, topic: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """Subscribe from the earliest offset and carry on past offsets already expired."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def event_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded messages with a ``value`` column.

    For file formats give ``path``; ``schema`` is the files' own schema and
    defaults to one message per row.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if path is None:
        return reader.load()
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.schema(schema or MESSAGE_SCHEMA).load(path)


def event_batch(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """The same messages read once, for backfills."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return reader.load() if path is None else reader.schema(MESSAGE_SCHEMA).load(path)
