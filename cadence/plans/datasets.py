"""Named datasets: a function from upstream DataFrames to one DataFrame,
with a declared layer, grain and materialisation (SURVEY §1.1, §1.5).

A ``Workspace`` resolves names lazily: views stay unevaluated so Catalyst
optimises across layers; a build replaces a table's entry by the re-read
written table.
"""

from __future__ import annotations

import inspect
import threading
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cadence.config import Config

VIEW = "view"
TABLE = "table"


@dataclass(frozen=True)
class Dataset:
    name: str
    layer: str
    deps: tuple[str, ...]
    fn: Callable[..., DataFrame]
    grain: tuple[str, ...]
    materialized: str
    partition_by: tuple[str, ...] = ()
    # Where a write deals its rows between two halves of ``fn``: the rows, the rest
    # (which follows from a row and small tables), and the column they are dealt by;
    # ``dealt``: the first half has dealt them already.
    halves: tuple[Callable[..., DataFrame], Callable[..., DataFrame], str] | None = None
    dealt: bool = False

    def wants_env(self) -> bool:
        return "env" in inspect.signature(self.fn).parameters


REGISTRY: dict[str, Dataset] = {}


def dataset(
    name: str,
    layer: str,
    deps: Iterable[str] = (),
    grain: Iterable[str] = (),
    materialized: str = VIEW,
    partition_by: Iterable[str] = (),
    halves: tuple[Callable[..., DataFrame], Callable[..., DataFrame], str] | None = None,
    dealt: bool = False,
):
    def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        REGISTRY[name] = Dataset(name, layer, tuple(deps), fn, tuple(grain), materialized,
                                 tuple(partition_by), halves, dealt)
        return fn

    return register


RAW_PREFIX = "raw_"


def raw_name(table: str) -> str:
    return f"{RAW_PREFIX}{table}"


@dataclass
class Env:
    spark: SparkSession
    cfg: Config
    # Frames are read with all their columns: one that follows from others is then
    # left out of shuffles; a query of a few columns would have to carry the others.
    whole: bool = False


class Workspace:
    """Lazy resolution of datasets over a given set of raw DataFrames."""

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame], cfg: Config,
                 adjust: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
                 whole: bool = False):
        _load_definitions()
        # Changes to single datasets on top of their definition (seeded faults, corrections).
        self.adjust = dict(adjust or {})
        self.env = Env(spark, cfg, whole)
        self.raw = raw
        self.frames: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self.frames and name.startswith(RAW_PREFIX) and name not in REGISTRY:
                self.frames[name] = self.raw[name[len(RAW_PREFIX):]]
            if name not in self.frames:
                ds = REGISTRY[name]
                df = ds.fn(**self._inputs(ds))
                self.frames[name] = self.adjust[name](df) if name in self.adjust else df
            return self.frames[name]

    def _inputs(self, ds: Dataset) -> dict:
        inputs = {dep: self[dep] for dep in ds.deps}
        return {**inputs, "env": self.env} if ds.wants_env() else inputs

    def halves(self, name: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame], str]:
        """The first half of a dataset, what makes the whole of it (adjusted as ever),
        and the column to deal the rows by in between."""
        ds = REGISTRY[name]
        first, rest, dealt_by = ds.halves
        with self._lock:
            inputs = self._inputs(ds)
        own = [{k: v for k, v in inputs.items() if k in inspect.signature(fn).parameters} for fn in (first, rest)]
        adjust = self.adjust.get(name, lambda df: df)
        return first(**own[0]), lambda rows: adjust(rest(rows, **own[1])), dealt_by

    def put(self, name: str, df: DataFrame) -> None:
        with self._lock:
            self.frames[name] = df


def topological_order(names: Iterable[str] | None = None) -> list[str]:
    """Datasets in dependency order (raw inputs excluded)."""
    _load_definitions()
    wanted = list(names) if names is not None else list(REGISTRY)
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen or n not in REGISTRY:
            return
        seen.add(n)
        for dep in REGISTRY[n].deps:
            visit(dep)
        order.append(n)

    for n in wanted:
        visit(n)
    return order


def descendants(name: str) -> set[str]:
    _load_definitions()
    out: set[str] = set()
    frontier = [name]
    while frontier:
        current = frontier.pop()
        for ds in REGISTRY.values():
            if current in ds.deps and ds.name not in out:
                out.add(ds.name)
                frontier.append(ds.name)
    return out


def _load_definitions() -> None:
    # Importing the layer modules registers their datasets.
    from cadence.operators import marts, reporting, staging  # noqa: F401
