"""From raw documents to a training mix: classify, dedupe, decontaminate, redact, mix.

Every stage takes (spark, docs, sf_dir), where ``docs`` is what the stage before left, and
returns documents with the columns of ``documents``; the mix adds ``copy``. ``run`` writes
each result as Parquet to the shared folder and reads it for the next stage, so a lost executor
costs at most the stage under way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm import decontam, mixing, neardup, secret_scan, weak_labels
from tickflow.llm.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier accepts."""
    return weak_labels.accepted_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return neardup.dedupe(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontam.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by marks."""
    return secret_scan.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it was taken."""
    return mixing.mix_documents(docs)


STAGES = [("quality_classifier", quality), ("near_dedup", near_dedup), ("decontamination", decontaminate),
          ("secret_scan", secrets), ("mix", mix)]

#: A trained classifier is part of the result, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
