"""Token-id output: Parquet files of token lists, in ascending document order.

Ids are dictionary-encoded list columns; document numbers, lengths and offsets
are delta-encoded. Row groups and pages are kept small and rows are sorted, so
that a reader of some documents, or of the numbers alone, skips the other
pages by their indexes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.llm.common import arrow_schema, materialise, row_id, slices, text_buffer
from cadence.llm.tokens import encoder

#: Bytes of a row group and of a page, rows of a page.
ROW_GROUP, PAGE, PAGE_ROWS = 32 << 20, 256 << 10, 2_000
IDS = "ids.list.element"


def file_options(id_column: str) -> dict[str, str]:
    """Writer options: version 2 pages, so that integers without a dictionary are delta-encoded."""
    plain = {f"parquet.enable.dictionary#{c}": "false" for c in (id_column, "n_tokens", "part_start")}
    return plain | {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(ROW_GROUP),
        "parquet.page.size": str(PAGE),
        "parquet.page.row.count.limit": str(PAGE_ROWS),
        "parquet.dictionary.page.size": str(1 << 20),
        f"parquet.enable.dictionary#{IDS}": "true",
        "parquet.columnindex.truncate.length": "64",
    }


def _encode_partition(tokenizer: str, text: str, id_column: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, start = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches, text):
            ids, at = enc.encode_buffer(*text_buffer(batch.column(text)))
            if end_id is not None:
                ids, at = np.insert(ids, at[1:], end_id), at + np.arange(len(at))
            n, ends = np.diff(at), at[1:]
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), lists, pa.array(n), pa.array(start + ends - n), pa.array(np.full(len(n), part, np.int32))],
                names=[id_column, "ids", "n_tokens", "part_start", "part"])
            start += int(ends[-1]) if len(ends) else 0

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, text: str = "text",
                      id_column: str = "doc_id", partitions: int | None = None) -> None:
    """Encode every whole text and write the files, ascending by ``id_column``.

    A null text is empty; a null number comes first. Rows of the same number
    follow each other by a hash of their text, then as they were read; since
    they may be many, ranges part them too. Columns other than the two named
    are not read. An empty table gives files without rows.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column), F.col(text), F.xxhash64(text).alias("_hash"), row_id().alias("_row"))
    order = [F.col(id_column).asc_nulls_first(), F.col("_hash"), F.col("_row")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(id_column, text)
    schema = f"{arrow_schema(rows, [id_column])}, ids array<int>, n_tokens bigint, part_start bigint, part int"
    coded = rows.mapInArrow(_encode_partition(tokenizer, text, id_column, end_id), schema)
    coded.write.options(**file_options(id_column)).parquet(path)


def read_token_files(spark: SparkSession, path: str, id_column: str = "doc_id", columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """The files' rows: ``id_column``, ``start``, ``n_tokens`` and ``columns``.

    ``start`` is the number of ids before the document in all files together:
    its place in its file, and the totals of the files before. The totals come
    from the small columns alone. Filters on ``id_column`` reach the files.
    """
    files = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a file: the window's input is the list of files. As a written
    # table its size is known, so Spark broadcasts it only where it is small.
    firsts = (files.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("_total"))
              .select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_first")))
    firsts = materialise(firsts, "token-file-starts")
    return files.select(id_column, "n_tokens", "part_start", "part", *columns).join(firsts, "part").select(
        id_column, (F.col("_first") + F.col("part_start")).alias("start"), "n_tokens", *columns)
