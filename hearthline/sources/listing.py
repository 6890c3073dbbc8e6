"""Files of a folder as a table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline.scratch import materialize, no_rows

LISTED = "path string, length long, modified timestamp"


def plain_path(encoded: Column) -> Column:
    """The path behind a file URI as Spark gives it, without its percent signs and surplus slashes."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def list_files(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """Every file below ``path`` (or a pattern of folders) with its length and modification time.

    Spark's file index does the listing, many folders at a time in tasks, and keeps it on the
    driver as for every scan; no content is read. Files of zero bytes, which scans pass over, are
    listed too, without a time. The table is written: it is the listing of one moment, however
    often it is read. Nothing there gives no rows.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names)
    try:
        found = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return no_rows(spark, StructType.fromDDL(LISTED))
        raise
    names_in = spark.createDataFrame([(name,) for name in found.inputFiles()], "value string")
    every = names_in.select(plain_path(F.col("value")).alias("path"))
    sized = found.select(
        F.regexp_replace("path", "^file:/+", "file:/").alias("path"),
        "length",
        F.col("modificationTime").alias("modified"),
    )
    listed = every.join(sized, "path", "left").select("path", F.coalesce("length", F.lit(0)).alias("length"), "modified")
    return materialize(listed, "listing")
