"""Tables bucketed on a key, for joins and aggregations without a shuffle.

Headers and lines that are written in the same number of buckets of the order
key, sorted within each, are joined and aggregated bucket by bucket: Spark
knows the buckets from the session catalogue and plans no exchange for either
side. The price is that a bucket is read by one task, which no runtime rule
splits. The rows of each bucket are therefore counted before the table is
written; where one holds more than ``SKEW`` times the mean, every table of the
set stays plain, and Spark shuffles and splits it as usual. Results are the
same either way.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A bucket beyond this multiple of the mean makes bucketing not worth while.
SKEW = 4.0


@dataclass(frozen=True)
class Bucketed:
    """A written table: enough to register it in another session."""

    path: str
    key: str
    buckets: int       # 0: plain
    schema: StructType


def bucket_rows(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows of each bucket, by the hash that Spark deals buckets with; at most ``buckets`` rows."""
    return df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def balanced(df: DataFrame, key: str, buckets: int, skew: float = SKEW) -> bool:
    """Whether no bucket holds more than ``skew`` times the mean. NULL keys
    share a bucket and count like any other value."""
    found = bucket_rows(df, key, buckets).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return not found["all"] or found["most"] <= skew * max(1.0, found["all"] / buckets)


def write(df: DataFrame, path: str, key: str, buckets: int) -> Bucketed:
    """Write ``df`` below ``path``, in ``buckets`` sorted buckets of ``key``, or plain for 0.

    Rows are dealt to the buckets by one shuffle on the key first, so that each
    bucket is one file however many tasks the input had."""
    if not buckets:
        df.write.mode("errorifexists").parquet(path)
        return Bucketed(path, key, 0, df.schema)
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("errorifexists").format("parquet").saveAsTable(name)
    # The files stay; each reader registers them under a name of its own.
    df.sparkSession.sql(f"DROP TABLE {name}")
    return Bucketed(path, key, buckets, df.schema)


def read(spark: SparkSession, table: Bucketed) -> DataFrame:
    """The table, registered in this session's catalogue where it has buckets."""
    if not table.buckets:
        return spark.read.schema(table.schema).parquet(table.path)
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{table.key}`) "
        f"SORTED BY (`{table.key}`) INTO {table.buckets} BUCKETS LOCATION '{table.path}'"
    )
    return spark.table(name)


def co_located(frames: Mapping[str, DataFrame], root: str, key: str, buckets: int) -> dict[str, DataFrame]:
    """Each frame as a table below ``root`` in the same buckets of ``key``; all plain where one is skewed."""
    count = buckets if all(balanced(df, key, buckets) for df in frames.values()) else 0
    return {name: read(df.sparkSession, write(df, f"{root.rstrip('/')}/{name}", key, count)) for name, df in frames.items()}
