"""Corpus pipeline: five stages from raw documents to placed training documents.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
what it returns is written as Parquet and read again as the next one's input.

Defined results: an empty table passes through all stages as an empty table.  Null
and empty texts are scored, kept or rejected like any other text, are no near
duplicates of anything, hold no benchmark window and have size 0 in the mix.  A null
source is a source of its own, null ids are passed through, repeated rows are near
duplicates of each other.  All columns of the input are kept; only the last stage
replaces columns named slot or shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, jaccard, mixing, prepare, quality, sharding
from ledgerlens.llm.queries import table
from ledgerlens.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepare(spark)
    return jaccard.one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or dropped so that sources come near their targets."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its slot and shard."""
    return sharding.place(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Learned scores, MinHash groups and the knapsack cannot be stated in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the result has its columns, slot and shard."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
