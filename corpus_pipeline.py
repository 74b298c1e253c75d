"""From raw documents to packed batches, in stages; each is written as Parquet and read again by the next.

Every stage keeps or drops whole rows with all their columns; the last one deals what is left to batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltframe.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from voltframe.llm.common import table
from voltframe.session import scratch_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine doesn't reject; it learns from the labelled rows of `sf_dir`."""
    machine = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, machine)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group with equal texts."""
    return exact_dedup.keepers(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near-duplicates."""
    return near_dedup.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document that is left."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", batches),
]

# Classifier scores have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        folder = scratch_folder(spark, f"stage-{name}")
        kept.write.parquet(folder)
        docs = spark.read.schema(kept.schema).parquet(folder)
    return docs
