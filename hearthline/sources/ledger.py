"""Which files a load has taken."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline.scratch import no_rows
from hearthline.sources.listing import LISTED


class LoadLedger:
    """An append-only table of loaded files: path, length, modification time, and when they were loaded.

    A file that has changed since is new again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        schema = f"{LISTED}, loaded timestamp"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return no_rows(self.spark, StructType.fromDDL(schema))
            raise

    def new_files(self, listed: DataFrame) -> DataFrame:
        """Listed files that are not in the ledger."""
        known = self.read().select(*(F.col(c).alias(f"known_{c}") for c in ("path", "length", "modified")))
        same = (
            (F.col("path") == F.col("known_path"))
            & (F.col("length") == F.col("known_length"))
            & F.col("modified").eqNullSafe(F.col("known_modified"))
        )
        return listed.join(known, same, "left_anti")

    def record(self, files: DataFrame) -> None:
        """Add files, after what they hold is safe; losing this step loads them again."""
        taken = files.select("path", "length", "modified", F.current_timestamp().alias("loaded"))
        taken.coalesce(1).write.mode("append").parquet(self.path)
