"""The registered queries of this subpackage, and the SQL beside those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm.collocations import collocations
from hearthline.llm.decontaminate import find_leaks
from hearthline.llm.language import identify_languages
from hearthline.llm.mixing import mix_sources
from hearthline.llm.ngram_join import ngram_join
from hearthline.llm.quality import score_quality
from hearthline.llm.quality_rules import quality_rules
from hearthline.llm.sharding import assign_shards
from hearthline.llm.sql import ORACLES
from hearthline.llm.top_k import exact_top_k
from hearthline.llm.toxicity import score_toxicity
from hearthline.llm.url_rules import filter_urls
from hearthline.llm.warc import read_warc, write_warc
from hearthline.llm.whitening import whiten

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int) -> Column:
    """The fold of a document: CRC-32 of its id, as text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(parts))


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, labels, fold(5) != 0)
    return scored.withColumn("held_out", fold(5) == 0).select("doc_id", "held_out", "score", "predicted")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_quality(docs, labels, fold(3) != 1)
    return scored.withColumn("held_out", fold(3) == 1).select("doc_id", "held_out", "score", "predicted")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign_shards(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_warc(write_warc(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(table(spark, sf_dir, "documents"), fold(4) != 2)
    return found.withColumn("held_out", fold(4) == 2).select("doc_id", "held_out", "lang_pred", "score")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the top of the repository, beside __spark_entry__.py

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_url_rules": op1_url_rules,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_mix_sources": op4_mix_sources,
    "op5_quality": op5_quality,
    "op6_sharding": op6_sharding,
    "op7_warc": op7_warc,
    "op8_language": op8_language,
    "op9_ngram_join": op9_ngram_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_top_k": op13_top_k,
    "pipeline": pipeline,
}
