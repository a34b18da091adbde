"""The corpus pipeline's stages: ``(spark, docs, sf_dir) -> DataFrame``.

All but the last return the columns of ``docs``. Each works on any table with
``doc_id``, ``text`` and ``source``, whatever other columns it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import lines, minhash, packing as packs, quality_rules as quality, secrets_scan
from cadence.llm.common import free_name, scratch_path
from cadence.llm.queries import vocabulary


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, counts the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted rules reject go; null and empty texts are among them."""
    whole = free_name(docs, "_document")
    packed = docs.select(F.struct(*docs.columns).alias(whole), F.col("text"))
    return quality.judge(packed, carry=(whole,)).filter("kept").select(f"{whole}.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on too many documents of a source go from its texts; near copies of a text count once."""
    return _counted(lines.drop_boilerplate(docs, F.col("source")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _counted(secrets_scan.redact(docs, scratch_path(spark, "secret-ledger")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their places in sequences."""
    packed = packs.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")
