"""Totals per time window and group, the same for batch and stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.schemas import EVENT_TIME

_AGGREGATES = {"avg": F.avg, "sum": F.sum}

# Output columns of the per-city totals, each an aggregate of a wire field.
CITY_MEASURES = {
    "average_price": ("avg", "price"),
    "total_living_area": ("sum", "livingArea"),
    "average_zestimate": ("avg", "zestimate"),
    "total_bedrooms": ("sum", "bedrooms"),
}

# Wire fields the per-city totals read.
CITY_FIELDS = ("timestamp", "city", "price", "livingArea", "zestimate", "bedrooms")


def window_totals(
    df: DataFrame,
    time: str = EVENT_TIME,
    group: str = "city",
    measures: Mapping[str, tuple[str, str]] = CITY_MEASURES,
    width: str = "1 minutes",
    watermark: str | None = "1 minutes",
) -> DataFrame:
    """Tumbling-window aggregates. Rows without event time belong to no window.

    The watermark only matters on a stream. Every measure aggregates partially
    before the shuffle, so a group with most of the rows costs no more than others.
    """
    if df.isStreaming and watermark:
        df = df.withWatermark(time, watermark)
    aggregates = [_AGGREGATES[how](column).alias(name) for name, (how, column) in measures.items()]
    return df.groupBy(F.window(time, width), group).agg(*aggregates)


def flatten_window(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` and ``window_end``."""
    rest = [F.col(name) for name in df.columns if name != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )
