"""Keyed-table scan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def scan_table(
    spark: SparkSession,
    table: str | None = None,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """A catalog table by name, or any data source by format, options and path.

    A keyed store is read through its connector, for example
    ``fmt="org.apache.spark.sql.cassandra"`` with ``table`` and ``keyspace`` options.
    """
    if fmt is None:
        if table is None:
            raise ValueError("give a table name or a format")
        return spark.table(table)
    return spark.read.format(fmt).options(**(options or {})).load(path)
