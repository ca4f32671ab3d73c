"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Each stage takes the documents that its predecessor kept and returns them with its decisions applied;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablemover.llm import decontaminate, mix, quality, sharding, simhash
from tablemover.llm.common import read_table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the factorisation machine rejects. It learns from the labelled rows of the
    documents it is given, outside the held-out fold."""
    return quality.keep_quality(docs, quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group within two bits."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come to their target weights."""
    return mix.mix_sources(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds slot and shard."""
    return sharding.assign_shards(docs, 32)


STAGES = [("quality", quality_classifier), ("simhash", simhash_dedup), ("decontaminate", decontamination),
          ("mix", source_mix), ("shard", shard)]

#: The classifier and the rounding draws have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
