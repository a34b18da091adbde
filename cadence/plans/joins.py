"""Join helper with a size check before any broadcast.

Policy (SURVEY §4): only a side whose size is a run parameter (the calendar:
one row per day of the configured range) is broadcast by hint, under
``MAX_BROADCAST_ROWS``. Sides that grow with the data get no hint: Catalyst
broadcasts them only where the size of the files or of the shuffled data is
under ``spark.sql.autoBroadcastJoinThreshold``, and AQE splits skewed
partitions of the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row count that is a run parameter and is broadcast by hint.
MAX_BROADCAST_ROWS = 2_000_000


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    known_rows: int | None = None,
) -> DataFrame:
    """Fact-to-dimension join; ``known_rows`` is the dimension's size where a
    parameter of the run fixes it."""
    if known_rows is not None and known_rows <= MAX_BROADCAST_ROWS:
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)
