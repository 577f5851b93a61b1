"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Stages, in order: documents whose toxicity score reaches the threshold go;
of equal texts the smallest id stays; of near-duplicate groups the smallest id
stays; sources are mixed to equal weights; each remaining copy is segmented.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


from starloom.llm import content_sort, mixing, segmentation, simhash, toxicity
from starloom.llm.common import prepare, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, learnt from the labelled rows among them."""
    prepare(spark)
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of equal normalised texts."""
    prepare(spark)
    return content_sort.keep_first(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, 4 bits)."""
    prepare(spark)
    return simhash.keep_one(docs, size=4, budget=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at equal weight by Poisson replication, globally shuffled."""
    prepare(spark)
    return mixing.mix(docs)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every copy."""
    prepare(spark)
    return segmentation.digests(docs)


STAGES = [("toxicity", toxicity_filter), ("exact_dedup", exact_dedup), ("simhash_dedup", simhash_dedup),
          ("mixing", mix_sources), ("segmentation", segment)]

# Learnt scores, XXH64 fingerprints and sampled segmentations have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
