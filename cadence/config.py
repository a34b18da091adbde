"""Run configuration: where layers live, calendar range, thresholds."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

# Fixed values that results depend on.
# Calendar default of the reference: 2016-01-01 inclusive to 2020-01-01 exclusive.
DEFAULT_CALENDAR_START = dt.date(2016, 1, 1)
DEFAULT_CALENDAR_END = dt.date(2020, 1, 1)
# The driver's test tables hold orders from 1995-01-01 to 2001-11-04, so they
# need a wider calendar: 1995-01-01 inclusive to 2002-01-01 exclusive.
FIXTURE_CALENDAR_START = dt.date(1995, 1, 1)
FIXTURE_CALENDAR_END = dt.date(2002, 1, 1)
# Header-vs-lines revenue tolerance of the reconciliation test.
REVENUE_TOLERANCE = "0.01"


@dataclass(frozen=True)
class Config:
    """Layer namespacing (I14) and run parameters.

    ``root`` is the shared storage folder under which every layer is written
    (``<root>/<prefix>_<layer>/<dataset>``). A CI run uses another ``prefix``
    but reads the same raw layer (``raw_prefix``).
    """

    root: str = ""
    prefix: str = "retail"
    raw_prefix: str = "retail"
    calendar_start: dt.date = DEFAULT_CALENDAR_START
    calendar_end: dt.date = DEFAULT_CALENDAR_END
    source_schema: str = "public"
    # Write tables that declare partition columns partitioned by them.
    partition_tables: bool = True
    layers: tuple[str, ...] = field(
        default=("raw", "staging", "intermediate", "marts", "reporting")
    )

    def layer_dir(self, layer: str) -> str:
        prefix = self.raw_prefix if layer == "raw" else self.prefix
        return f"{self.root.rstrip('/')}/{prefix}_{layer}"

    def dataset_dir(self, layer: str, name: str) -> str:
        return f"{self.layer_dir(layer)}/{name}"

    def raw_table_name(self, table: str) -> str:
        """Destination name of a source table (I3): ``<schema>_<table>``."""
        return f"{self.source_schema}_{table}"

    def for_ci(self, ci_prefix: str = "retail_ci") -> "Config":
        return replace(self, prefix=ci_prefix)

    def with_fixture_calendar(self) -> "Config":
        return replace(
            self,
            calendar_start=FIXTURE_CALENDAR_START,
            calendar_end=FIXTURE_CALENDAR_END,
        )

    @property
    def calendar_days(self) -> int:
        return (self.calendar_end - self.calendar_start).days


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    It is read from the session. Where it is unset, a local run (driver and
    executors are one process) gets a folder of its own; on a cluster that is
    an error, as a folder of one machine would lose data.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cadence-shared-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def default_config(spark: SparkSession, run_name: str | None = None) -> Config:
    """A config rooted in the shared folder, one sub-folder per run."""
    base = shared_dir(spark).rstrip("/")
    run = run_name or f"run-{os.getpid()}-{dt.datetime.now():%Y%m%d%H%M%S%f}"
    return Config(root=f"{base}/cadence/{run}")
