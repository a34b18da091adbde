"""Independent Spark jobs submitted from driver threads.

The warehouse build ran four models at a time; here independent datasets,
loads and test groups are submitted as concurrent Spark jobs, which share
the executors. Tasks are submitted in dependency order to a FIFO pool, so
when a task starts, every task it waits for has already started: waiting
cannot deadlock.

``shuffles_released`` frees the disk of a job's shuffles as soon as it is done.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

T = TypeVar("T")

# Spark's own removal of shuffle files at the end of a query's execution.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing = threading.Lock()
# Per session: blocks that are open, and the setting found by the first.
_released: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries made and run in the block leave no shuffle files behind. Without it
    they stay until the driver collects its garbage, and a load or build has those
    of all its jobs on disk at once. For frames that are run once: another run of
    the same one would make its shuffles again."""
    with _releasing:
        blocks, before = _released.get(spark) or (0, spark.conf.get(RELEASE, None))
        _released[spark] = (blocks + 1, before)
        spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        with _releasing:
            blocks, before = _released[spark]
            if blocks > 1:
                _released[spark] = (blocks - 1, before)
            else:
                del _released[spark]
                spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)

DEFAULT_WORKERS = 4


def run_all(tasks: Mapping[str, Callable[[], T]], workers: int = DEFAULT_WORKERS) -> dict[str, T]:
    """Run independent tasks concurrently; results by name."""
    return run_graph({name: ((), fn) for name, fn in tasks.items()}, workers)


def run_graph(
    tasks: Mapping[str, tuple[Sequence[str], Callable[[], T]]],
    workers: int = DEFAULT_WORKERS,
) -> dict[str, T]:
    """Run ``tasks`` (name -> (dependencies, fn)), each after its
    dependencies; ``tasks`` must be given in dependency order."""
    futures: dict[str, Future] = {}

    def wrap(name: str, deps: Sequence[str], fn: Callable[[], T]) -> Callable[[], T]:
        def task() -> T:
            for dep in deps:
                if dep in futures:
                    futures[dep].result()
            return fn()

        return task

    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        for name, (deps, fn) in tasks.items():
            unknown = [d for d in deps if d in tasks and d not in futures]
            if unknown:
                raise ValueError(f"{name} is listed before its dependencies {unknown}")
            futures[name] = pool.submit(wrap(name, deps, fn))
        return {name: f.result() for name, f in futures.items()}
