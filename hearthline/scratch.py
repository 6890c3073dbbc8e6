"""Intermediate files, always on storage that every executor can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder, or a fresh temporary one in local mode."""
    global _local_root
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="hearthline-")
    return _local_root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below one folder per application, which can go once that has ended."""
    folder = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever it is stored; nothing happens if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop(written: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote to scratch and nobody reads any more."""
    for path in {file.rsplit("/", 1)[0] for file in written.inputFiles()}:
        remove(written.sparkSession, path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application has put in scratch; for the end of a job."""
    remove(spark, f"{scratch_root(spark)}/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return the written table.

    Unlike a cache this survives lost executors, cuts the lineage, and lets each
    later query read only the columns it needs.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table that the planner knows to be empty."""
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
