"""SQL access to the datasets: each becomes a temporary view under its own
name, so SQL written against the warehouse tables runs on ``spark.sql``.

Views are lazy: ``spark.sql`` plans through them down to the parquet scans
(or the raw layer), with the same pushdown and pruning as DataFrame code.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from cadence.plans.datasets import REGISTRY, Workspace


def register_views(ws: Workspace, names: Iterable[str] | None = None,
                   prefix: str = "") -> list[str]:
    """Register datasets (default: all) as temporary views named
    ``<prefix><dataset>``; returns the view names."""
    registered = []
    for name in names if names is not None else REGISTRY:
        view = f"{prefix}{name}"
        ws[name].createOrReplaceTempView(view)
        registered.append(view)
    return registered


def run_sql(ws: Workspace, text: str, names: Iterable[str]) -> DataFrame:
    """Register ``names`` and run ``text`` with ``spark.sql``."""
    register_views(ws, names)
    return ws.env.spark.sql(text)
