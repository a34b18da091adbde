"""Benchmark of the headline datasets and queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Steps, in the order a daily refresh runs them:

* ``ingest``        load the nine source tables into the raw layer
                    (replace / upsert, lineage, observed counts);
* ``fct_orders``, ``rpt_sales``, ``rpt_orders``
                    each computed from the raw layer (one Catalyst plan,
                    executed into a no-op sink);
* ``build``         every table of marts and reporting written, in order;
* ``dq_report``     the 118 tests over the built tables;
* ``kpi_revenue_store_month`` and the other KPIs, over the built tables.

The JVM is warmed up first on the smallest tables (untimed). Prints one
JSON line; ``value`` is the sum of the headline steps.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("fct_orders", "rpt_sales", "rpt_orders", "dq_report", "kpi_revenue_store_month")
WARMUP_DIR = "/root/testdata/sf0.001"


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run(spark, sf_dir: str, timings: dict | None) -> None:
    from cadence.operators import kpi, quality
    from cadence.plans.build import build
    from cadence.plans.datasets import Workspace
    from cadence.queries import run_config
    from cadence.sources import ingest
    from cadence.sources.fixtures import raw_tables

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        if timings is not None:
            timings[name] = round(time.perf_counter() - t0, 3)
        return out

    cfg = run_config(spark, "bench").with_fixture_calendar()
    loads = timed("ingest", lambda: ingest.ingest(spark, raw_tables(spark, sf_dir), cfg))
    raw = ingest.LoadedRaw(spark, cfg, loads)
    for name in ("fct_orders", "rpt_sales", "rpt_orders"):
        timed(name, lambda n=name: _noop(Workspace(spark, raw, cfg)[n]))
    built = timed("build", lambda: build(spark, raw, cfg, run_tests=False, gate=False))
    ws = built.workspace
    timed("dq_report", lambda: quality.run_suite(ws))
    sales, orders, stocks = ws["rpt_sales"], ws["rpt_orders"], ws["rpt_stocks"]
    timed("kpi_revenue_store_month", lambda: _noop(kpi.revenue_store_month(sales)))
    others = [
        lambda: _noop(kpi.top_products(sales)),
        lambda: _noop(kpi.customer_value(sales)),
        lambda: _noop(kpi.customer_geo(sales)),
        lambda: _noop(kpi.late_rate(orders)),
        lambda: _noop(kpi.shipping_delay(orders)),
        lambda: _noop(kpi.stockout_rate(stocks)),
        lambda: _noop(kpi.turnover(sales, stocks)),
    ]
    timed("kpi_others", lambda: [f() for f in others])


def main() -> None:
    from cadence.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus,
                          app_name="cadence-bench", driver_memory="16g")
    if os.path.isdir(WARMUP_DIR) and os.path.abspath(sf_dir) != WARMUP_DIR:
        run(spark, WARMUP_DIR, None)
    timings: dict[str, float] = {}
    run(spark, sf_dir, timings)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_seconds",
        "value": round(sum(timings[k] for k in HEADLINE), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "spark": spark.version,
        "cores": cpus,
    }
    spark.stop()
    print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main()
