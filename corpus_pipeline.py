"""Corpus pipeline: five stages over the documents table, each one an operator of grantlake.llm.

Every stage takes (spark, docs, sf_dir), where docs is what the stage before it kept, and returns a DataFrame; all but
the last return the columns of documents.  The tables that a stage needs besides come from sf_dir.  What a stage keeps
is written as Parquet to the shared folder and read again by the next one, so no stage is computed twice; what the next
one has stored its own rows from is deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from grantlake.llm.cotrain import drop_low_quality
from grantlake.llm.decontam import drop_contaminated
from grantlake.llm.neardup import drop_near_duplicates
from grantlake.llm.packing import pack
from grantlake.llm.shared import discard, shared_folder
from grantlake.llm.substring import drop_repeated_passages


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    return drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    return drop_repeated_passages(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with benchmark passages."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can't express trained scores, digests of chunks and tokens; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents table; each one's rows are stored before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    home = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{home}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            discard(spark, before)
        before = path
    return docs
