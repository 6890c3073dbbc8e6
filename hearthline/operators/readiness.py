"""Is there enough data to train on?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.operators.keyed_table import namespace_exists, table_exists

# Fewer rows than the first bound cannot train, fewer than the second can with care.
TRAINABLE = 100
COMFORTABLE = 500


def readiness(df: DataFrame) -> DataFrame:
    """One row: ``row_count``, ``status``, ``ok``."""
    rows = F.col("row_count")
    status = (
        F.when(rows == 0, "NO DATA")
        .when(rows < TRAINABLE, "NOT ENOUGH DATA")
        .when(rows < COMFORTABLE, "MINIMAL DATA")
        .otherwise("READY")
    )
    return df.agg(F.count("*").alias("row_count")).select(
        rows, status.alias("status"), (rows >= TRAINABLE).alias("ok")
    )


def table_readiness(
    spark: SparkSession, namespace: str, table: str, rows: DataFrame | None = None
) -> tuple[bool, str]:
    """Verdict and reason for a catalog table, or for ``rows`` of a store in its place.

    A missing table is reported, not raised.
    """
    if rows is None:
        if not namespace_exists(spark, namespace):
            return False, f"namespace {namespace} does not exist"
        if not table_exists(spark, namespace, table):
            return False, f"table {namespace}.{table} does not exist"
        rows = spark.table(f"{namespace}.{table}")
    verdict = readiness(rows).first()
    return verdict["ok"], f"{verdict['row_count']:,} rows: {verdict['status']}"
