"""Incremental merge loads as a Structured Streaming query.

Change files land in a folder; a file-source stream picks up what is new
since its checkpoint, and each micro-batch is upserted into the raw table
with ``merge_load`` (I5). Run with ``availableNow`` it processes what has
arrived and stops, the streaming form of the daily refresh.

Exactly-once: the checkpoint records which files each epoch read, and names
the query; an epoch's load id is made of both, so an epoch retried after a
failure finds itself in the table's ledger and adds neither rows nor a
version. A query with a new checkpoint is another query with loads of its own.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cadence.sources.files import Files
from cadence.sources.ingest import SEQ, merge_load


def change_stream(spark: SparkSession, folder: str, schema: str | StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet change files under ``folder`` as a stream (schema pinned)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def start_upsert_stream(
    changes: DataFrame,
    table_dir: str,
    key: Sequence[str],
    checkpoint_dir: str,
    name: str = "upsert",
    seq: str | None = SEQ,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert every micro-batch of ``changes`` into ``table_dir`` on ``key``."""

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        # Spark writes the query's id into the checkpoint before the first epoch.
        query = json.loads(Files(batch.sparkSession, checkpoint_dir).read(f"{checkpoint_dir.rstrip('/')}/metadata"))["id"]
        merge_load(batch, table_dir, key, load_id=f"{name}-{query}-epoch-{epoch_id}", name=name,
                   seq=seq)

    writer = (
        changes.writeStream.queryName(f"{name}_upsert")
        .foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint_dir)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
