"""cadence: retail ELT and analytics as Spark DataFrame plans.

Layers, in build order:

* ``sources``    raw tables: readers, replace / upsert loads, lineage, reconciliation
* ``operators``  staging, intermediate, marts, reporting, data quality, KPIs
* ``functions``  reusable ``Column`` expressions (casts, keys, calendar, revenue)
* ``plans``      dataset graph, gated build, checked joins
* ``streaming``  micro-batch upsert of change feeds into raw tables
"""

from cadence.config import Config

__all__ = ["Config"]
