"""The corpus pipeline: documents to training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row that its
predecessor kept; its result is written as Parquet and reread as the ``docs`` of
the next one. All but the last return the columns of ``documents``. The
near-duplicate stage has no SQL form, so ``ORACLE_SQL`` is None and
``tests/llm/test_pipeline.py`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulse.llm import decontam, minhash, packing, quality
from pulse.llm.storage import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the risk-controlled cutoffs."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of exact and near copies."""
    return minhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = written(stage(spark, out, sf_dir), f"pipeline-{name}")
    return out
