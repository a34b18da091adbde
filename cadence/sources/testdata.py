"""Readers for the driver's parquet tables.

Schemas are pinned, so opening a table reads no footer on the driver and a
changed file fails loudly instead of silently re-typing a column. Each
table is opened once per ``TestData``; the scan itself stays lazy, with
column pruning and filter pushdown down to the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values that results depend on: schemas of the driver's tables.
TESTDATA_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}
TESTDATA_TABLES = tuple(TESTDATA_SCHEMAS)


class TestData:
    """The driver's tables under one scale-factor folder."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            reader = self.spark.read
            if name in TESTDATA_SCHEMAS:
                reader = reader.schema(TESTDATA_SCHEMAS[name])
            self._frames[name] = reader.parquet(self.path(name))
        return self._frames[name]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return TestData(spark, sf_dir).table(name)
