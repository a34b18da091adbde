"""Corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import stages
from cadence.llm.common import scratch_path

#: (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's documents.
STAGES = [
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup),
    ("near_dedup", stages.near_dedup),
    ("secret_scan", stages.secret_scan),
    ("packing", stages.packing),
]

#: Tokenization, shingle signatures and fitted rules are not expressible in SQL;
#: tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is a table of its own."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
