"""Loading source tables into the raw layer.

* ``replace_load``: full refresh, idempotent (I4).
* ``merge_load``: upsert on a single or composite primary key (I5): the
  batch is landed once in the shared folder, so that a live source is read
  once, and made key-unique (latest ``_seq`` wins); current rows whose key
  is in the batch are dropped by a left-anti join, the batch is appended;
  when rows carry ``_seq`` the stored ``_seq`` is kept and a late, older
  change does not overwrite a newer one. A NULL key part is a value like
  any other: it equals NULL, so loads repeat without adding rows.
  Rows missing from the batch stay: source deletions are not propagated.
  The table lies in hash buckets of its key; only buckets that a key of the
  batch falls into are read and written, the new version refers to the
  folders of the others.
  Columns new in the batch are added, NULL in older rows, and types widen
  (I7, ``cadence.sources.evolution``).
* both publish over the version that was current when they began, or raise
  ``store.Conflict``; a load whose id the table's ledger has is not done
  again: it returns the version and rows of the first time.
* every raw row carries ``_load_id`` and a deterministic ``_row_id`` (I6).
* the rows a load emits are those of the extracted batch, counted by
  ``observe`` as they are landed, before any de-duplication (I9).

A batch in which no key comes twice, as a count per key shows, is taken as it
is. The de-duplication of others is an aggregation (``max`` of a struct ordered by ``_seq``), so partial aggregation runs before the shuffle and a key repeated
a million times in one batch is still cheap; both join sides are key-unique
afterwards, so the anti join cannot be skewed.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadence.catalog import MERGE, SourceTable, select_tables
from cadence.config import Config
from cadence.plans.concurrent import run_all, shuffles_released
from cadence.sources import store
from cadence.sources.evolution import conform, merged_schema, whole_number
from cadence.sources.files import Files

LOAD_ID = "_load_id"
ROW_ID = "_row_id"
SEQ = "_seq"
LINEAGE = (LOAD_ID, ROW_ID)
# Load-trace columns, dropped when the raw layer is read by staging.
TRACE = (LOAD_ID, ROW_ID, SEQ)
# Rows of a bucket when a table is made, and the number of buckets.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 1_000_000, 8, 8192


@dataclass(frozen=True)
class LoadResult:
    table: str          # destination name, e.g. public_orders
    source_table: str   # e.g. orders
    mode: str
    load_id: str
    version: str
    emitted_rows: int


def new_load_id() -> str:
    return f"{dt.datetime.now(dt.timezone.utc).timestamp():.6f}"


def add_lineage(df: DataFrame, key: Sequence[str], load_id: str) -> DataFrame:
    """Load id plus a row id derived from the key and the load id, so the
    same row of the same load always gets the same id."""
    return with_row_id(df.withColumn(LOAD_ID, F.lit(load_id)), key)


def with_row_id(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The row id of rows that have their load id."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key] + [F.col(LOAD_ID)]
    return df.withColumn(ROW_ID, F.sha2(F.concat_ws("|", *parts), 256))


def latest_per_key(batch: DataFrame, key: Sequence[str], seq: str | None = SEQ,
                   tiebreak: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """One row per key: the one with the highest ``seq``, then the highest
    ``tiebreak`` columns, then the other columns (so the choice is
    deterministic). Rows whose keys are known to be ``unique`` stay as they are."""
    first = ([seq] if seq and seq in batch.columns else []) + [
        c for c in tiebreak if c in batch.columns
    ]
    rest = [c for c in batch.columns if c not in key and c not in first]
    order = first + rest
    if not order:
        return batch.select(*key).distinct()
    if unique:
        return batch.select(*key, *order)
    best = F.max(F.struct(*[F.col(c) for c in order])).alias("_best")
    picked = batch.groupBy(*key).agg(best)
    return picked.select(*key, *[F.col(f"_best.{c}").alias(c) for c in order])


def _matching(rows: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on ``key`` in which NULL equals NULL. The keys of a
    landed batch have a known size: Catalyst broadcasts them where they are
    small, and the stored table is then not shuffled."""
    other = keys.select(*[F.col(k).alias(f"_key_{k}") for k in key])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key])
    return rows.join(other, same, how)


def upsert(current: DataFrame | None, batch: DataFrame, key: Sequence[str],
           seq: str | None = SEQ, tiebreak: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Merge ``batch`` into ``current`` on ``key``: new keys are inserted,
    keys not in the batch are kept. For a key in both, the batch row wins,
    unless both carry ``seq`` and the stored row's is higher (a late,
    older change does not overwrite a newer one). ``unique``: no key comes
    twice in the batch."""
    latest = latest_per_key(batch, key, seq, tiebreak, unique)
    if current is None:
        return latest
    kept = _matching(current, batch, key, "left_anti")
    if seq and seq in latest.columns and seq in current.columns:
        rivals = _matching(current, batch, key, "left_semi")
        both = rivals.unionByName(latest, allowMissingColumns=True)
        latest = latest_per_key(both, key, seq, tiebreak)
    return kept.unionByName(latest, allowMissingColumns=True)


def replace_load(df: DataFrame, table_dir: str, key: Sequence[str], load_id: str,
                 name: str = "table") -> tuple[str, int]:
    """Full refresh: the new version holds exactly ``df``."""
    spark = df.sparkSession
    if done := store.finished(spark, table_dir, load_id):
        return done
    base, _ = store.current(spark, table_dir)
    version, emitted = store.write_counted(add_lineage(df, key, load_id), table_dir, name)
    store.write_manifest(spark, table_dir, version, store.Manifest(load=store.Load(load_id, emitted)))
    return _publish(spark, table_dir, version, base, load_id) or (version, emitted)


def _publish(spark: SparkSession, table_dir: str, version: str, base: int, load_id: str) -> tuple[str, int] | None:
    """Publish; a result only where another attempt of the same load was first."""
    try:
        store.publish(spark, table_dir, version, base)
    except store.Conflict:
        if done := store.finished(spark, table_dir, load_id):
            return done
        raise
    return None


def bucket_count(rows: int, per_bucket: int = BUCKET_ROWS) -> int:
    """Buckets of a new table: a power of two, about ``per_bucket`` rows each."""
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << max(0, rows // per_bucket).bit_length()))


def merge_load(batch: DataFrame, table_dir: str, key: Sequence[str], load_id: str,
               name: str = "table", seq: str | None = SEQ, buckets: int | None = None) -> tuple[str, int]:
    """Upsert ``batch`` into the table's current version; the buckets that its
    keys fall into are written as the next version. ``buckets`` of a new table
    default to its first batch's size. Returns the version and the number of
    rows the batch emitted. Raises ``store.Conflict`` when another load was
    published since the current version was read."""
    spark = batch.sparkSession
    if done := store.finished(spark, table_dir, load_id):
        return done
    number, base = store.current(spark, table_dir)
    fresh = batch.withColumn(LOAD_ID, F.lit(load_id))
    landing = f"{table_dir.rstrip('/')}/_landed"
    landed_version, emitted = store.write_counted(fresh, landing, name)
    landed = store.read_version(spark, landing, landed_version)
    old, current, count = None, None, buckets or bucket_count(emitted)
    # A row id follows from the key's text and the load id: it is made as the rows are
    # written and is in no shuffle, unless the text of a key may have changed since.
    late = True
    if base is not None:
        stored = store.read_version(spark, table_dir, base).schema
        identified = with_row_id(landed, key)
        schema, renamed = merged_schema(stored, identified.schema, key)
        old = store.manifest(spark, table_dir, base)
        if old and old.folders is not None and old.key == tuple(key) and _same_place(stored, schema, key):
            count = old.buckets
        else:
            old = None  # another key, or a plain version: all of it is dealt anew
        late = old is not None and LOAD_ID in stored.names and _same_place(landed.schema, schema, key)
        landed = conform(identified, schema, renamed)
        landed = landed.drop(ROW_ID) if late else landed
    touched, unique = _keys_of(landed, key, count)
    if base is None:
        landed = landed.drop(LOAD_ID)  # one value: it is added with the row ids
    else:
        current = store.read_version(spark, table_dir, base, touched if old else None)
        current = conform(current, schema).withColumn("_from_batch", F.lit(0))
        current = current.drop(ROW_ID) if late else current
        if not old:
            touched |= _buckets_of(current, key, count)
    merged = upsert(current, landed.withColumn("_from_batch", F.lit(1)), key, seq, tiebreak=["_from_batch"], unique=unique)
    merged = merged.drop("_from_batch")
    columns = [*merged.columns, LOAD_ID, ROW_ID] if base is None else schema.names

    def traced(rows: DataFrame) -> DataFrame:
        return rows.withColumn(LOAD_ID, F.lit(load_id)) if base is None else rows

    version = store.write_buckets(
        merged, table_dir, key, sorted(touched), old, count, store.Load(load_id, emitted),
        lambda dealt: (with_row_id(traced(dealt), key) if late else dealt).select(*columns, store.BUCKET))
    done = _publish(spark, table_dir, version, number, load_id) or (version, emitted)
    # The batch is in the table; a load that fails before this leaves it for inspection.
    Files(spark, landing).remove(store.version_path(landing, landed_version))
    return done


def _keys_of(rows: DataFrame, key: Sequence[str], count: int) -> tuple[set[int], bool]:
    """Buckets that have rows, and whether no key comes twice; only keys are
    shuffled, combined before."""
    per_key = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    with shuffles_released(rows.sparkSession):
        found = per_key.agg(F.collect_set(store.bucket_of(key, count)).alias("buckets"), F.max("_n").alias("most")).first()
    return set(found["buckets"]), (found["most"] or 0) <= 1


def _buckets_of(rows: DataFrame, key: Sequence[str], count: int) -> set[int]:
    """Buckets that have rows: at most one number each comes to the driver."""
    with shuffles_released(rows.sparkSession):
        return {r[0] for r in rows.select(store.bucket_of(key, count)).distinct().collect()}


def _same_place(stored: StructType, now: StructType, key: Sequence[str]) -> bool:
    """Whether stored keys stay in their buckets: the text of a key must not change with its type."""
    return all(stored[k].dataType == now[k].dataType or (whole_number(stored[k].dataType) and whole_number(now[k].dataType)) for k in key)


LOADS_TABLE = "_loads"
LOADS_SCHEMA = (
    "load_id string, table_name string, source_table string, load_mode string, "
    "version string, emitted_rows bigint, loaded_at timestamp"
)


def ingest(spark: SparkSession, source: Mapping[str, DataFrame], cfg: Config,
           only: Sequence[str] | None = None, load_id: str | None = None,
           workers: int = 8) -> list[LoadResult]:
    """Load the selected source tables into ``<root>/<raw_prefix>_raw``:
    merge tables are upserted on their key, the others replaced. Tables are
    loaded as concurrent Spark jobs; results come in catalogue order and are
    appended to the load log (one row per table)."""
    load_id = load_id or new_load_id()
    tables = select_tables(only)
    frames = {t.name: source[t.name] for t in tables}
    done = run_all(
        {t.name: (lambda t=t: load_table(spark, frames[t.name], t, cfg, load_id))
         for t in tables},
        workers,
    )
    results = [done[t.name] for t in tables]
    log_loads(spark, cfg, results)
    return results


def log_loads(spark: SparkSession, cfg: Config, results: Sequence[LoadResult]) -> None:
    """Enter the loads in ``<raw>/_loads``: one row per table and load id,
    however often the load is repeated."""
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3]
    log = cfg.dataset_dir("raw", LOADS_TABLE)
    files = Files(spark, log)
    for r in results:
        row = {"load_id": r.load_id, "table_name": r.table, "source_table": r.source_table, "load_mode": r.mode,
               "version": r.version, "emitted_rows": int(r.emitted_rows), "loaded_at": stamp}
        entry = hashlib.sha256(f"{r.table} {r.load_id}".encode()).hexdigest()[:32]
        files.put(log, f"{entry}.json", json.dumps(row) + "\n")


def read_load_log(spark: SparkSession, cfg: Config) -> DataFrame:
    return spark.read.schema(LOADS_SCHEMA).json(cfg.dataset_dir("raw", LOADS_TABLE))


def load_table(spark: SparkSession, df: DataFrame, table: SourceTable, cfg: Config,
               load_id: str) -> LoadResult:
    dest = cfg.raw_table_name(table.name)
    table_dir = cfg.dataset_dir("raw", dest)
    if table.mode == MERGE:
        version, emitted = merge_load(df, table_dir, table.key, load_id, dest)
    else:
        version, emitted = replace_load(df, table_dir, table.key, load_id, dest)
    return LoadResult(dest, table.name, table.mode, load_id, version, emitted)


def read_raw(spark: SparkSession, cfg: Config, table: str) -> DataFrame:
    """The current raw table, without its load-trace columns."""
    df = store.read_current(spark, cfg.dataset_dir("raw", cfg.raw_table_name(table)))
    return df.drop(*TRACE)


class LoadedRaw(Mapping):
    """The raw layer as written by ``ingest``, read on first access: the
    versions in ``results`` when given, else each table's current version."""

    def __init__(self, spark: SparkSession, cfg: Config,
                 results: Sequence[LoadResult] | None = None):
        self.spark = spark
        self.cfg = cfg
        self.versions = {r.source_table: r.version for r in results or ()}
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._frames:
            if table in self.versions:
                table_dir = self.cfg.dataset_dir("raw", self.cfg.raw_table_name(table))
                df = store.read_version(self.spark, table_dir, self.versions[table])
                self._frames[table] = df.drop(*TRACE)
            else:
                self._frames[table] = read_raw(self.spark, self.cfg, table)
        return self._frames[table]

    def __iter__(self):
        return iter(t.name for t in select_tables())

    def __len__(self) -> int:
        return len(select_tables())
