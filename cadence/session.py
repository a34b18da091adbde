"""SparkSession settings used by tests, bench and local runs.

On a cluster the session comes from the platform; these settings are the
ones the library relies on and are safe to set there too (AQE, skew-join
splitting, ANSI casts, UTC).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans are designed around.
PLAN_SETTINGS = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # sort-merge-join partitions (a hot customer or store), switch a join to
    # broadcast when a shuffled side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Hard casts must fail on bad input, as in the warehouse.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "cadence",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**PLAN_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sizing(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20,
           shuffle_expansion: float = 1.0) -> dict[str, str]:
    """Settings for a run reading ``input_bytes`` of parquet on
    ``total_cores`` executor cores.

    Shuffle partitions are sized so that each holds about
    ``target_partition_bytes`` of shuffled data (``shuffle_expansion`` is the
    shuffled / scanned ratio), rounded up to whole waves of the cluster; AQE
    then coalesces small ones and splits skewed ones. Scan splits use the same
    target. For 100 TB on 1000 executors x 8 cores this gives 752,000
    partitions of at most 128 MiB (94 waves), each small enough to sort or
    hash in executor memory without spilling most of the time.
    """
    wanted = max(1, int(input_bytes * shuffle_expansion // target_partition_bytes) + 1)
    waves = -(-wanted // max(1, total_cores))
    return {
        "spark.sql.shuffle.partitions": str(waves * max(1, total_cores)),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(waves * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
