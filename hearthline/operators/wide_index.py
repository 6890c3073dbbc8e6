"""Index of a category column with any number of values, as a table instead of a fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.scratch import materialize

_ROW_BITS = 33  # Spark's running id: the partition above, the row in it below


def wide_index(df: DataFrame, column: str) -> DataFrame:
    """Every value with its place by falling frequency, ties by value: ``column``, ``rows``, ``index`` from 0.

    The places of ``StringIndexer``, but no value ever reaches the driver: the counts are sorted by
    ranges, each partition numbers its rows, and the partitions' sizes give their offsets. Nulls
    have no place.
    """
    name = f"`{column}`"
    counts = df.filter(F.col(name).isNotNull()).groupBy(F.col(name)).agg(F.count("*").alias("rows"))
    ordered = counts.orderBy(F.desc("rows"), F.col(name)).withColumn("_id", F.monotonically_increasing_id())
    numbered = materialize(ordered, "wide-index")
    part = F.shiftright("_id", _ROW_BITS).alias("_part")
    # One row for each partition of the sort.
    sizes = numbered.groupBy(part).agg(F.count("*").alias("size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        numbered.withColumn("_part", part)
        .join(offsets, "_part")
        .select(F.col(name), "rows", place.cast("long").alias("index"))
    )


def index_wide(df: DataFrame, column: str, index: DataFrame, output: str | None = None) -> DataFrame:
    """Add the place of each row's value as a double; values without one, and nulls, share the next.

    As ``StringIndexer`` keeps unseen values. A plain join: few values are broadcast, a frequent
    one is split by adaptive execution.
    """
    output = output or f"{column}_index"
    places = index.select(F.col(f"`{column}`").alias("_value"), F.col("index").cast("double").alias("_place"))
    unseen = float(index.count())
    joined = df.join(places, F.col(f"`{column}`") == F.col("_value"), "left")
    kept = [F.col(f"`{name}`") for name in df.columns if name != output]
    return joined.select(*kept, F.coalesce("_place", F.lit(unseen)).alias(output))
