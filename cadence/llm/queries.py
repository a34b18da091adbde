"""The registered queries of this subpackage, one per operator, and their SQL.

Each applies its operator, with production parameters, to the whole of its
table and returns the whole result.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm import ann, bpe, filter_audit, lines, minhash, mixing, oracle, packing, quality_rules, runs, secrets_scan, sharding, substring, token_files
from cadence.llm.common import materialise, scratch_path


def vocabulary(name: str) -> str:
    """Place of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_hilbert_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ledger = scratch_path(spark, "secret-ledger")
    # Two scans, as of a corpus that has grown: the second meets blobs that the ledger holds, and covers every row.
    secrets_scan.scan(docs.filter(F.col("doc_id") % 2 == 0), ledger)
    found = secrets_scan.findings(docs, ledger)
    listed = found.withColumn("spans", secrets_scan.listing())
    counts = [F.size(r.name).cast("bigint").alias(f"n_{r.name}") for r in secrets_scan.RULES]
    return listed.select("doc_id", *counts, F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op5_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op6_chunk_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.drop_repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "repeats_of", F.size("removed").alias("n_removed"), "removed", "text")


def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    shown = pages.select("page_id", lines.host(F.col("url")).alias("host"), lines.page_lines(F.col("html")).alias("text"))
    # The markup is taken off once; the operator reads the lines twice.
    clean = lines.drop_boilerplate(materialise(shown, "pages"), F.col("host"), dropped="n_dropped")
    return clean.select("page_id", "host", F.col("n_dropped").cast("bigint"), "text")


def op9_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    shards = sharding.shard_documents(docs, 24, measures={"text_crc32": crc})
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@F.pandas_udf(T.LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    import zlib

    return ids.map(lambda x: zlib.crc32(x.astype("<u4").tobytes())).astype("int64")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, path, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", ids_crc32("ids").alias("ids_crc32"))


def op11_multinomial_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents"), F.col("source")))


def op12_filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), stretch=True, whole=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (op1_chunk_reuse_bpe, op2_hilbert_curves, op3_prob_minhash, op4_blob_ledger_secrets, op5_weak_supervision,
            op6_chunk_passages, op7_best_two_fit, op8_site_lines, op9_minimax_shards, op10_token_files, op11_multinomial_mix, op12_filter_orders, op13_periodic_runs)
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL
