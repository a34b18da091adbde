"""Versioned parquet tables in the shared folder.

    <table>/v-<id>/                     parquet files written for one version
    <table>/_manifests/<version>.json   folders and types of a bucketed version, and its load
    <table>/_pointers/<number>/         claims on that number, and the version settled for it
    <table>/_done/<load>                finished loads: version and emitted rows

A plain version is its folder. A bucketed version is a list of folders, one
per hash bucket of the key; a version made from another one writes the buckets
that it touches and refers to the folders of the others.

The highest settled number is current. A writer that read number n proposes
its version for n + 1 (``cadence.sources.claims``): one proposal wins, whatever
the file system, and the others raise ``Conflict``, so no update is lost and
no reader sees two versions of one number. Nothing is overwritten, and a
failed or lost job leaves the previous version current. Versions go by
``expire`` only. A read error is raised, never taken for an empty table.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.plans.concurrent import shuffles_released
from cadence.sources import claims
from cadence.sources.evolution import conform
from cadence.sources.files import Files

# Row ids and surrogate keys are hexadecimal text, which only an entropy coder halves.
COMPRESSION = "zstd"
POINTERS, MANIFESTS, DONE, PINS = "_pointers", "_manifests", "_done", "_pins"
BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer published since the base version was read."""


def new_version() -> str:
    return f"v-{uuid.uuid4().hex}"


def _root(table_dir: str) -> str:
    return table_dir.rstrip("/")


def version_path(table_dir: str, version: str) -> str:
    return f"{_root(table_dir)}/{version}"


def _numbers(files: Files, table_dir: str) -> list[int]:
    return sorted((int(n) for n in files.names(f"{_root(table_dir)}/{POINTERS}") if n.isdigit()), reverse=True)


def _pointer(table_dir: str, number: int) -> str:
    return f"{_root(table_dir)}/{POINTERS}/{number:012d}"


def current(spark: SparkSession, table_dir: str) -> tuple[int, str | None]:
    """Number and name of the current version; (0, None) when nothing was
    published. Numbers that no writer has settled yet do not count."""
    files = Files(spark, table_dir)
    for number in _numbers(files, table_dir):
        if version := claims.settled(files, _pointer(table_dir, number)):
            return number, version
    return 0, None


def current_version(spark: SparkSession, table_dir: str) -> str | None:
    return current(spark, table_dir)[1]


def exists(spark: SparkSession, table_dir: str) -> bool:
    return current_version(spark, table_dir) is not None


def read_current(spark: SparkSession, table_dir: str) -> DataFrame:
    """The current version; a table never published is an error."""
    version = current_version(spark, table_dir)
    if version is None:
        raise FileNotFoundError(f"no published version under {table_dir}")
    return read_version(spark, table_dir, version)


def write_version(df: DataFrame, table_dir: str, partition_by: list[str] | None = None,
                  dealt_by: str | None = None, finish: Callable[[DataFrame], DataFrame] | None = None,
                  dealt: bool = False, sort_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new, not yet published version; return its name.

    A partitioned write is first rebalanced on the partition columns: rows of
    a value go to few files, small values share a task, and AQE splits a value
    that holds a third of the rows over many. No sampling pass. ``dealt_by``
    stands for the partition columns where ``finish`` only adds them afterwards,
    with other columns that need not be shuffled. Rows that are ``dealt``, so that few
    tasks hold a value, are written where they lie. A partition's rows are sorted by
    ``sort_by`` in place of the sort by partition that the write needs anyway: text
    that belongs to a key then lies together and packs well."""
    version = new_version()
    if partition_by and not dealt:
        df = df.hint("rebalance", *([dealt_by] if dealt_by else partition_by))
    df = finish(df) if finish else df
    if partition_by and sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("errorifexists").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_released(df.sparkSession):
        writer.parquet(version_path(table_dir, version))
    return version


def write_counted(df: DataFrame, table_dir: str, name: str = "rows",
                  partition_by: list[str] | None = None, dealt_by: str | None = None,
                  finish: Callable[[DataFrame], DataFrame] | None = None, dealt: bool = False,
                  sort_by: Sequence[str] = ()) -> tuple[str, int]:
    """``write_version`` that also counts the rows written, in the same pass."""
    obs = Observation(f"written_{name}_{uuid.uuid4().hex[:8]}")

    def counted(rows: DataFrame) -> DataFrame:
        return rows.observe(obs, F.count(F.lit(1)).alias("n"))

    if finish:
        version = write_version(df, table_dir, partition_by, dealt_by, lambda rows: counted(finish(rows)), dealt, sort_by)
    else:
        version = write_version(counted(df), table_dir, partition_by, dealt=dealt, sort_by=sort_by)
    return version, int(obs.get["n"])


@dataclass(frozen=True)
class Load:
    """Identity of a load and the rows it emitted."""

    load_id: str
    emitted_rows: int


@dataclass(frozen=True)
class Manifest:
    """What a version consists of. ``folders``: bucket -> (folder, place of its types in ``schemas``);
    None for a plain version."""

    folders: dict[int, tuple[str, int]] | None = None
    schemas: tuple[T.StructType, ...] = ()
    key: tuple[str, ...] = ()
    buckets: int = 0
    load: Load | None = None

    @property
    def schema(self) -> T.StructType:
        """Types of the table: those of the latest write, which hold all earlier ones."""
        return self.schemas[-1]

    def to_json(self) -> str:
        return json.dumps({"folders": None if self.folders is None else [[b, *f] for b, f in sorted(self.folders.items())],
                           "schemas": [json.loads(s.json()) for s in self.schemas], "key": self.key, "buckets": self.buckets,
                           "load": self.load and [self.load.load_id, self.load.emitted_rows]})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        m = json.loads(text)
        folders = None if m["folders"] is None else {b: (f, s) for b, f, s in m["folders"]}
        return cls(folders, tuple(T.StructType.fromJson(s) for s in m["schemas"]), tuple(m["key"]), m["buckets"], m["load"] and Load(*m["load"]))


def manifest(spark: SparkSession, table_dir: str, version: str) -> Manifest | None:
    text = Files(spark, table_dir).read(f"{_root(table_dir)}/{MANIFESTS}/{version}.json")
    return None if text is None else Manifest.from_json(text)


def write_manifest(spark: SparkSession, table_dir: str, version: str, m: Manifest) -> None:
    Files(spark, table_dir).put(f"{_root(table_dir)}/{MANIFESTS}", f"{version}.json", m.to_json())


def read_version(spark: SparkSession, table_dir: str, version: str, only: Iterable[int] | None = None) -> DataFrame:
    """A version's rows; of a bucketed one ``only`` some buckets."""
    m = manifest(spark, table_dir, version)
    if m is None or m.folders is None:
        return spark.read.parquet(version_path(table_dir, version))
    wanted = m.folders if only is None else {b: m.folders[b] for b in only if b in m.folders}
    by_types: dict[int, list[str]] = {}
    for folder, types in wanted.values():
        by_types.setdefault(types, []).append(f"{_root(table_dir)}/{folder}")
    # Folders written before a type was widened are read with their own types.
    parts = [conform(spark.read.schema(m.schemas[t]).parquet(*sorted(paths)), m.schema) for t, paths in sorted(by_types.items())]
    if not parts:
        return spark.createDataFrame([], m.schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """Hash bucket of a key; the text of the parts counts, so that a widened whole number stays where it is."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, table_dir: str, key: Sequence[str], touched: Sequence[int], old: Manifest | None,
                  buckets: int, load: Load | None = None, finish: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write the ``touched`` buckets, whose rows are ``df``, as a version that shares the others with ``old``.
    ``finish`` adds what follows from a row alone, after the rows are dealt to their buckets."""
    version = new_version()
    rows = df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
    rows = finish(rows) if finish else rows
    schema = rows.drop(BUCKET).schema
    with shuffles_released(df.sparkSession):
        rows.write.mode("errorifexists").option("compression", COMPRESSION).partitionBy(BUCKET).parquet(version_path(table_dir, version))
    kept = {b: f for b, f in (old.folders or {}).items() if b not in set(touched)} if old else {}
    used = sorted({s for _, s in kept.values()})
    place = {s: k for k, s in enumerate(used)}
    folders = {b: (f, place[s]) for b, (f, s) in kept.items()}
    folders |= {b: (f"{version}/{BUCKET}={b}", len(used)) for b in touched}
    schemas = (*(old.schemas[s] for s in used), schema) if old else (schema,)
    write_manifest(df.sparkSession, table_dir, version, Manifest(folders, schemas, tuple(key), buckets, load))
    return version


def folders(spark: SparkSession, table_dir: str, version: str) -> dict[int, str]:
    """Folder of each bucket of a bucketed version."""
    m = manifest(spark, table_dir, version)
    return {} if m is None or m.folders is None else {b: f for b, (f, _) in m.folders.items()}


def _ledger_entry(load_id: str) -> str:
    return hashlib.sha256(load_id.encode()).hexdigest()[:32]


def _finish(spark: SparkSession, table_dir: str, version: str | None) -> None:
    """Enter a published version's load in the ledger."""
    m = version and manifest(spark, table_dir, version)
    if m and m.load:
        Files(spark, table_dir).put(f"{_root(table_dir)}/{DONE}", _ledger_entry(m.load.load_id), json.dumps([version, m.load.emitted_rows]))


def finished(spark: SparkSession, table_dir: str, load_id: str) -> tuple[str, int] | None:
    """Version and emitted rows of a load that the table has seen to its end."""
    # A writer may have stopped between publishing and the ledger: the current version's load counts.
    _finish(spark, table_dir, current_version(spark, table_dir))
    entry = Files(spark, table_dir).read(f"{_root(table_dir)}/{DONE}/{_ledger_entry(load_id)}")
    return None if entry is None else tuple(json.loads(entry))


def publish(spark: SparkSession, table_dir: str, version: str, base: int) -> None:
    """Make ``version`` the current one. ``base`` is the number of the version
    that was current when the work on it began."""
    number, before = current(spark, table_dir)
    if number != base and before != version:
        raise Conflict(f"{table_dir} has been published since number {base}")
    if before != version:
        # The ledger is complete up to the version that is replaced.
        _finish(spark, table_dir, before)
        if claims.settle(Files(spark, table_dir), _pointer(table_dir, base + 1), version) != version:
            raise Conflict(f"{table_dir} has been published since number {base}")
    _finish(spark, table_dir, version)


def write_and_publish(df: DataFrame, table_dir: str,
                      partition_by: list[str] | None = None, dealt: bool = False) -> DataFrame:
    """Write a new version, publish it, return it re-read from storage."""
    spark = df.sparkSession
    base, _ = current(spark, table_dir)
    version = write_version(df, table_dir, partition_by, dealt=dealt)
    publish(spark, table_dir, version, base)
    return read_version(spark, table_dir, version)


def pin(spark: SparkSession, table_dir: str, version: str, hours: float = 24) -> str:
    """Keep a version while a reader uses it, for ``hours`` at most; returns the pin for ``unpin``."""
    name = f"{version}.{int(time.time() + 3600 * hours)}.{uuid.uuid4().hex[:8]}"
    Files(spark, table_dir).put(f"{_root(table_dir)}/{PINS}", name)
    return name


def unpin(spark: SparkSession, table_dir: str, name: str) -> None:
    Files(spark, table_dir).remove(f"{_root(table_dir)}/{PINS}/{name}")


def expire(spark: SparkSession, table_dir: str, keep: int = 2) -> list[str]:
    """Remove versions that are neither among the ``keep`` latest published ones nor pinned; their names.

    A folder goes only when no version that stays refers to it, so buckets
    carried over from an old version survive it. The pointers of removed
    versions go with them; the latest stay, so that a writer with an old base
    is still refused. Versions that were never published, and landed batches,
    stay while a later number is open: call this between loads.
    """
    files, root = Files(spark, table_dir), _root(table_dir)
    settled = [(n, v) for n in _numbers(files, table_dir) if (v := claims.settled(files, _pointer(table_dir, n)))]
    now, staying = time.time(), {v for _, v in settled[: max(1, keep)]}
    for entry in files.names(f"{root}/{PINS}"):
        version, until, _ = entry.split(".")
        if int(until) >= now:
            staying.add(version)
        else:
            files.remove(f"{root}/{PINS}/{entry}")
    going = [(n, v) for n, v in settled if v not in staying]
    used = {v: {f for f in folders(spark, table_dir, v).values()} | {v} for _, v in settled}
    held = set().union(*(used[v] for v in staying if v in used)) if staying else set()
    for number, version in going:
        for folder in used[version] - held:
            # A bucketed version's folder goes bucket by bucket while others refer into it.
            if folder == version and any(f.startswith(f"{version}/") for f in held):
                continue
            files.remove(f"{root}/{folder}")
        files.remove(f"{root}/{MANIFESTS}/{version}.json")
        files.remove(_pointer(table_dir, number))
    return [v for _, v in going]
