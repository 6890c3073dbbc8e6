"""The training-data pipeline: five stages over documents, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm.decontaminate import remove_leaking
from hearthline.llm.mixing import mix_sources, mixed_rows
from hearthline.llm.ngram_join import ngram_join
from hearthline.llm.quality import keep_good
from hearthline.llm.rows import keyed_rows
from hearthline.llm.sharding import assign_shards
from hearthline.scratch import drop, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from every label."""
    return keep_good(docs, _table(spark, sf_dir, "labels"), F.lit(True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: that with the smallest id, then the first in the files.

    Rows without an id, and rows that repeat one, are judged each by its own text.
    """
    keyed, key = keyed_rows(docs)
    rows = keyed.select(F.struct("doc_id", key).alias("row"), "text")
    found = ngram_join(rows, "row")
    dropped = found.filter("doc_id <> component_id").select(F.col(f"doc_id.{key}").alias(key))
    return keyed.join(dropped, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return remove_leaking(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each row, repeats as rows of their own."""
    keyed, key = keyed_rows(docs)
    taken, _ = mix_sources(keyed, key_col=key)
    return mixed_rows(keyed, taken, key)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row."""
    return assign_shards(docs, 16)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("sharded", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        done = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if number:  # the documents themselves stay
            drop(docs)
        docs = done
    return docs


#: A trained classifier decides the first stage, so SQL can't give run()'s rows.
ORACLE_SQL = None
