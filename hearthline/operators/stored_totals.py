"""Window totals kept as mergeable parts of loads."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.operators.windows import CITY_MEASURES
from hearthline.schemas import EVENT_TIME
from hearthline.scratch import drop, materialize, remove


class StoredTotals:
    """Per-window, per-group sums and counts, one set for each load, below ``path``.

    A load that comes again replaces its own part, whatever was added since; totals are the sum of
    all parts. They need no stream's state, so they outlive its loss, and rows that come late are
    one more load. ``measures`` are those of ``window_totals``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        group: str = "city",
        measures: Mapping[str, tuple[str, str]] = CITY_MEASURES,
        width: str = "1 minutes",
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.group = group
        self.measures = dict(measures)
        self.width = width

    def _partial(self) -> list[Column]:
        """A sum and a number of values for each field that a measure reads."""
        fields = sorted({field for _, field in self.measures.values()})
        sums = [F.sum(f"`{field}`").alias(f"sum_{field}") for field in fields]
        return [*sums, *(F.count(f"`{field}`").alias(f"count_{field}") for field in fields)]

    def put(self, load: str, df: DataFrame, time: str = EVENT_TIME) -> None:
        """Store the part of one load, in place of an earlier one of that name.

        Rows without event time belong to no window; a load without any leaves none of its own.
        Other loads' files are not touched.
        """
        found = df.groupBy(F.window(time, self.width), self.group).agg(*self._partial())
        parts = materialize(found, "window-totals")
        if parts.isEmpty():
            remove(self.spark, f"{self.path}/load={quote(load, safe='')}")
        else:
            (
                parts.withColumn("load", F.lit(load))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("load")
                .parquet(self.path)
            )
        drop(parts)

    def loads(self) -> list[str]:
        parts = self._parts()
        return sorted(row[0] for row in parts.select("load").distinct().collect()) if parts else []

    def _parts(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path).withColumn("load", F.col("load").cast("string"))
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _merged(self, parts: DataFrame) -> DataFrame:
        numbers = [name for name in parts.columns if name not in ("window", self.group, "load")]
        return parts.groupBy("window", self.group).agg(*(F.sum(f"`{n}`").alias(n) for n in numbers))

    def read(self) -> DataFrame | None:
        """The totals of all loads, in the shape of ``window_totals``; None before the first load."""
        parts = self._parts()
        if parts is None:
            return None

        def total(how: str, field: str) -> Column:
            found = F.col(f"`sum_{field}`")
            return found if how == "sum" else F.try_divide(found, F.col(f"`count_{field}`"))

        aggregates = [total(how, field).alias(name) for name, (how, field) in self.measures.items()]
        return self._merged(parts).select("window", self.group, *aggregates)
