"""Three-point row-count reconciliation: source = emitted = stored.

Per table two checks, both WARN (a divergence is reported, downstream
builds go on):

* ``source_row_count_matches_load``: rows at the source vs rows the load
  emitted (loss during extraction);
* ``stored_row_count_matches_load``: rows stored in the raw layer vs rows
  the load emitted (loss during loading).

``passed`` is false when either side is missing; ``delta = reference -
emitted`` only when both exist. After deletions at the source a merged
table legitimately holds more rows than were emitted; the check then warns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.catalog import TABLES_BY_NAME, select_tables
from cadence.config import Config
from cadence.sources import store
from cadence.sources.ingest import LoadResult

SOURCE_CHECK = "source_row_count_matches_load"
STORED_CHECK = "stored_row_count_matches_load"
SEVERITY = "WARN"
COUNT_SCHEMA = "table_name string, n bigint"


def _union(frames: Iterable[DataFrame], spark: SparkSession) -> DataFrame:
    frames = list(frames)
    if not frames:
        return spark.createDataFrame([], COUNT_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), frames)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit(name).alias("table_name"), "n"
    )


def source_counts(spark: SparkSession, source: Mapping[str, DataFrame], cfg: Config,
                  only: Sequence[str] | None = None) -> DataFrame:
    """I8: ``COUNT(*)`` per source table, as one union of aggregates."""
    return _union(
        (_count(source[t.name], cfg.raw_table_name(t.name)) for t in select_tables(only)), spark
    )


def emitted_counts(spark: SparkSession, results: Iterable[LoadResult]) -> DataFrame:
    """Rows each load emitted (observed during its write); one row per
    loaded table."""
    rows = [(r.table, int(r.emitted_rows)) for r in results]
    return spark.createDataFrame(rows, COUNT_SCHEMA)


def stored_counts(spark: SparkSession, cfg: Config,
                  results: Sequence[LoadResult]) -> DataFrame:
    """Rows in the version each load published, re-read from storage
    (the count comes from the parquet footers)."""
    parts = []
    for r in results:
        table_dir = cfg.dataset_dir("raw", r.table)
        parts.append(_count(store.read_version(spark, table_dir, r.version), r.table))
    return _union(parts, spark)


def strategy_labels(spark: SparkSession, cfg: Config) -> DataFrame:
    """Load-strategy label per destination table."""
    rows = [(cfg.raw_table_name(t.name), t.strategy_label) for t in TABLES_BY_NAME.values()]
    return spark.createDataFrame(rows, "table_name string, load_strategy string")


def checks(source: DataFrame, emitted: DataFrame, stored: DataFrame,
           labels: DataFrame) -> DataFrame:
    """Two checks per table from three count tables (full outer joins
    on the table name, so a table missing on one side still shows)."""
    s = source.select("table_name", F.col("n").alias("source_rows"))
    e = emitted.select("table_name", F.col("n").alias("emitted_rows"))
    w = stored.select("table_name", F.col("n").alias("stored_rows"))
    counts = s.join(e, "table_name", "full_outer").join(w, "table_name", "full_outer")
    counts = counts.join(labels, "table_name", "left")

    def one(check: str, ref: str) -> DataFrame:
        both = F.col(ref).isNotNull() & F.col("emitted_rows").isNotNull()
        return counts.select(
            "table_name",
            F.lit(check).alias("check_name"),
            F.col(ref).alias("reference_rows"),
            F.col("emitted_rows"),
            F.when(both, F.col(ref) - F.col("emitted_rows")).alias("delta"),
            F.coalesce(F.col(ref) == F.col("emitted_rows"), F.lit(False)).alias("passed"),
            F.lit(SEVERITY).alias("severity"),
            F.col("load_strategy"),
        )

    return one(SOURCE_CHECK, "source_rows").unionByName(one(STORED_CHECK, "stored_rows"))


def reconcile(spark: SparkSession, source: Mapping[str, DataFrame], cfg: Config,
              results: Sequence[LoadResult], only: Sequence[str] | None = None) -> DataFrame:
    return checks(
        source_counts(spark, source, cfg, only),
        emitted_counts(spark, results),
        stored_counts(spark, cfg, results),
        strategy_labels(spark, cfg),
    )
