"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.llm.cotrain import score_quality
from grantlake.llm.decontam import decontaminate
from grantlake.llm.filter_audit import filter_audit
from grantlake.llm.grid_codes import vector_codes
from grantlake.llm.language import identify
from grantlake.llm.licences import licence_scan
from grantlake.llm.neardup import near_duplicates
from grantlake.llm.oracle import ORACLE as ORACLE
from grantlake.llm.packing import pack, pack_conversations
from grantlake.llm.pieces import encode
from grantlake.llm.quality_rules import base_statistics, quality_rules
from grantlake.llm.substring import repeated_passages
from grantlake.llm.toxicity import toxicity
from grantlake.llm.wrapper import extract


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``op1_quality_rules`` counts, without the trees."""
    return base_statistics(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def packed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_conversations(table(spark, sf_dir, "conversations"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("text_key")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents")).drop("spans")


def licence_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``op7_licence_scan`` says about the phrases."""
    return op7_licence_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the ids take the place of the text, which needn't come back
    both = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ids="text", decoded="decoded").withColumnRenamed("text", "ids")
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        quality_base,
        op2_packing,
        packed_conversations,
        op3_decontamination,
        op4_toxicity,
        op5_substring_dedup,
        op6_minhash_near_dedup,
        op7_licence_scan,
        licence_base,
        op8_quality_classifier,
        op9_html_extraction,
        op10_language_id,
        op11_vector_codes,
        op12_sentencepiece,
        op13_filter_audit,
    )
}
