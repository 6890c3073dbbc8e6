"""JSON payloads: decode messages into columns, encode rows into messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline.functions.event_time import event_time
from hearthline.schemas import EVENT_TIME, wire_schema


def decode_payload(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """One row per message with the schema's fields as top-level columns.

    A message that is not JSON gives a row of nulls, a field of the wrong type a
    null in that field, an unknown key nothing. ``explode`` rather than a plain
    projection: filters on parsed fields (the null-time filter of a time window)
    would otherwise move below it and parse every message twice.
    """
    record = F.from_json(F.col(value).cast("string"), schema)
    return df.select(F.explode(F.array(record)).alias("data")).select("data.*")


def parse_events(
    df: DataFrame,
    fields: Sequence[str] | None = None,
    unit: str = "ms",
    fractional: bool = False,
    value: str = "value",
) -> DataFrame:
    """Decode listing messages under the stream view of the wire schema.

    Name ``fields`` to decode only what the job reads. ``fractional`` accepts
    event times with a fraction, which are null otherwise.
    """
    schema = wire_schema(fields, price="double", timestamp="double" if fractional else "long")
    parsed = decode_payload(df, schema, value)
    if EVENT_TIME not in parsed.columns:
        return parsed
    return parsed.withColumn(EVENT_TIME, event_time(F.col(EVENT_TIME), unit))


def encode_payload(*columns: Column | str) -> Column:
    """One JSON object per row; null fields are written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def marked_messages(df: DataFrame, size: int, value: str = "value") -> DataFrame:
    """Messages with ``readable``, whether they are JSON, and the number of their ``batch`` of ``size``.

    Null messages are left out: they hold nothing. Write the result before it is used twice, so
    that each message is made and checked once.
    """
    batch = F.floor(F.monotonically_increasing_id() / size).alias("batch")
    return df.select(F.col(value).cast("string").alias(value), batch).filter(F.col(value).isNotNull()).select(
        value, "batch", is_json(F.col(value)).alias("readable")
    )


def encode_batches(df: DataFrame, size: int, value: str = "value") -> DataFrame:
    """Pack JSON texts into JSON arrays of at most ``size``; others are left out.

    One text that is not JSON would make its whole array unreadable, so each is checked.
    Batches follow the running row id of each partition, so no group can hold
    more than ``size`` rows whatever the data looks like. Row ids repeat only if
    row order does: give it a scan, not the output of a shuffle.
    """
    return pack_marked(marked_messages(df, size, value), value)


def pack_marked(marked: DataFrame, value: str = "value") -> DataFrame:
    """The readable ones of ``marked_messages`` as arrays, one for each batch."""
    packed = marked.filter("readable").groupBy("batch").agg(json_array(F.collect_list(value)).alias(value))
    return packed.select(value)


def is_json(text: Column) -> Column:
    """Whether a text is JSON; false for null."""
    return F.try_parse_json(text.cast("string")).isNotNull()


def json_array(objects: Column) -> Column:
    """Array of JSON texts to the text of one JSON array."""
    return F.concat(F.lit("["), F.array_join(objects, ", "), F.lit("]"))
