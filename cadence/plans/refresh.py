"""The daily refresh in one call: load the raw layer,
reconcile row counts (WARN: reported, never blocking), then the gated build."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cadence.config import Config
from cadence.plans.build import BuildResult, build
from cadence.sources import ingest, reconcile


@dataclass
class RefreshResult:
    loads: list[ingest.LoadResult]
    checks: list  # rows of the reconciliation checks (two per table)
    build: BuildResult

    @property
    def warnings(self) -> list:
        return [r for r in self.checks if not r["passed"]]


def refresh(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    cfg: Config,
    only: Sequence[str] | None = None,
    select: Iterable[str] | None = None,
    run_tests: bool = True,
) -> RefreshResult:
    loads = ingest.ingest(spark, source, cfg, only)
    checks = reconcile.reconcile(spark, source, cfg, loads, only).collect()
    raw = ingest.LoadedRaw(spark, cfg, loads)
    built = build(spark, raw, cfg, select=select, run_tests=run_tests)
    return RefreshResult(loads, checks, built)
