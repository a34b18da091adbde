"""Helpers shared by the operators: tables in the shared folder, text buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.config import shared_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage at a table that survives the loss of any executor, so
    later reads neither repeat Python work nor see other row numbers.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_id() -> Column:
    """A number for each row; stable only once the table has been written."""
    return F.monotonically_increasing_id()


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def arrow_schema(df: DataFrame, columns: list[str]) -> str:
    """DDL of some columns of ``df``, for the output schema of a map over batches."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in columns)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that the texts of each hold about ``limit`` bytes, or one text."""
    for batch in batches:
        _, ends = text_buffer(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
