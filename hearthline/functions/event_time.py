"""Event time and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FROM_EPOCH = {"ms": F.timestamp_millis, "s": F.timestamp_seconds}
_PER_SECOND = {"ms": 1000, "s": 1}
# A timestamp is a 64-bit number of microseconds; this leaves time windows room at either end.
_MOST_SECONDS = 9_000_000_000_000


def event_time(column: Column, unit: str = "ms") -> Column:
    """Epoch number to timestamp.

    Producers write milliseconds; reading such a number straight as a timestamp
    takes it for seconds, tens of thousands of years ahead. A double (fractional
    milliseconds) is cut to a whole number first. A number that no timestamp can hold
    is null: one absurd message must not end a stream.
    """
    number = column.try_cast("long")
    most = _MOST_SECONDS * _PER_SECOND[unit]
    return F.when(number.between(-most, most), _FROM_EPOCH[unit](number))


def date_parts(column: Column) -> list[Column]:
    """Zero-padded ``year``, ``month`` and ``day`` strings."""
    return [
        F.date_format(column, pattern).alias(name)
        for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))
    ]
