"""A key for every row of a written table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.scratch import materialize


def keyed_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key that no two rows share, whatever they hold, and the key's name.

    The key is the row's file and place in it, so every scan of the table gives the same one, at no
    cost. What is not read from Parquet files is written to some first.
    """
    taken = {name.lower() for name in docs.columns}
    name = "row_key"
    while name in taken:
        name += "_"
    key = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select("*", key.alias(name)), name
    except AnalysisException:
        written = materialize(docs, "keyed-rows")
        return written.select("*", key.alias(name)), name
