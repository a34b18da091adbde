"""Commit protocol, touched buckets, replays, widened types, expiry."""

import random
import threading

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from cadence.config import Config
from cadence.sources import claims, ingest, store
from cadence.sources.evolution import common_type, conform, merged_schema


def _table(spark, rows, schema="id bigint, v string"):
    return spark.createDataFrame(rows, schema)


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


class Shared:
    """The files of one folder, in memory; each call is one step of a schedule."""

    def __init__(self):
        self.kept, self.lock, self.turns = {}, threading.Lock(), random.Random(0)

    def names(self, folder):
        with self.lock:
            return sorted(self.kept)

    def put(self, folder, name, text=""):
        with self.lock:
            self.kept.setdefault(name, text)


class Stopped(Exception):
    pass


class Failing(Shared):
    """A writer's view that stops after so many writes."""

    def __init__(self, shared, writes):
        self.shared, self.left = shared, writes

    def names(self, folder):
        return self.shared.names(folder)

    def put(self, folder, name, text=""):
        if not self.left:
            raise Stopped
        self.left -= 1
        self.shared.put(folder, name, text)


@pytest.mark.parametrize("seed", range(20))
def test_one_proposal_wins_under_contention(monkeypatch, seed):
    monkeypatch.setattr(claims, "WAIT", 0.0005)
    shared, out = Shared(), {}
    gate = threading.Barrier(6)

    def write(k):
        gate.wait()
        out[k] = claims.settle(shared, "p", f"v-{seed}-{k}")

    threads = [threading.Thread(target=write, args=(k,)) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(out) == 6 and len(set(out.values())) == 1
    assert len([n for n in shared.kept if n.startswith("settled.")]) == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=5))
def test_writers_that_stop_block_nobody_and_change_nothing_settled(writes):
    shared, values = Shared(), set()
    for k, n in enumerate(writes):
        try:
            values.add(claims.settle(Failing(shared, n), "p", f"w{k}"))
        except Stopped:
            pass
    values.add(claims.settle(shared, "p", "last"))
    assert len(values) == 1 and claims.settled(shared, "p") in values


@pytest.mark.parametrize("run", range(4))
def test_six_publishes_from_one_base_have_one_winner(spark, tmp_root, run):
    d = f"{tmp_root}/race"
    ingest.merge_load(_table(spark, [(0, "base")]), d, ["id"], "L0")
    base, _ = store.current(spark, d)
    versions = [store.write_version(_table(spark, [(k, "w")]), d) for k in range(6)]
    won, lost, gate = [], [], threading.Barrier(6)

    def publish(v):
        gate.wait()
        try:
            store.publish(spark, d, v, base)
            won.append(v)
        except store.Conflict:
            lost.append(v)

    threads = [threading.Thread(target=publish, args=(v,)) for v in versions]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == 5
    assert store.current(spark, d) == (base + 1, won[0])


def test_replace_load_and_stale_base_are_refused(spark, tmp_root):
    d = f"{tmp_root}/s"
    ingest.replace_load(_table(spark, [(1, "a")]), d, ["id"], "L1")
    base, _ = store.current(spark, d)
    mine = store.write_version(_table(spark, [(1, "mine")]), d)
    ingest.replace_load(_table(spark, [(1, "b")]), d, ["id"], "L2")
    for _ in range(2):
        with pytest.raises(store.Conflict):
            store.publish(spark, d, mine, base)
    assert got(store.read_current(spark, d), "id", "v") == [(1, "b")]
    # Publishing what is current already is no conflict: the writer may not know that it won.
    number, version = store.current(spark, d)
    store.publish(spark, d, version, number - 1)


def test_untouched_buckets_are_carried_over(spark, tmp_root):
    d = f"{tmp_root}/b"
    first, _ = ingest.merge_load(_table(spark, [(k, "a") for k in range(400)]), d, ["id"], "L1", buckets=16)
    second, _ = ingest.merge_load(_table(spark, [(7, "new"), (1000, "x")]), d, ["id"], "L2")
    before, after = store.folders(spark, d, first), store.folders(spark, d, second)
    place = {r[0] for r in _table(spark, [(7, ""), (1000, "")]).select(store.bucket_of(["id"], 16)).collect()}
    assert set(before) == set(after) == set(range(16))
    assert {b for b in after if after[b] != before[b]} == place
    assert got(store.read_version(spark, d, second), "id", "v") == got(_table(spark, [(k, "new" if k == 7 else "a") for k in range(400)] + [(1000, "x")]), "id", "v")
    assert store.read_version(spark, d, first).where("v <> 'a'").count() == 0
    # An empty batch touches nothing; another key deals the table anew.
    third, _ = ingest.merge_load(_table(spark, []), d, ["id"], "L3")
    assert store.folders(spark, d, third) == after
    ingest.merge_load(_table(spark, [(7, "q")]), d, ["id", "v"], "L4")
    assert store.read_current(spark, d).where("id = 7").count() == 2


def test_replayed_load_adds_no_version_and_no_log_row(spark, tmp_root):
    cfg = Config(root=tmp_root)
    rows = {"orders": _table(spark, [(1, 1), (2, 1)], "order_id bigint, customer_id bigint"),
            "stores": _table(spark, [(1, "s")], "store_id bigint, store_name string")}
    runs = [ingest.ingest(spark, rows, cfg, only=list(rows), load_id="L1") for _ in range(2)]
    assert runs[0] == runs[1] and [r.emitted_rows for r in runs[1]] == [2, 1]
    log = ingest.read_load_log(spark, cfg).collect()
    assert len(log) == 2 and all(r.loaded_at is not None for r in log)
    assert all(store.current(spark, cfg.dataset_dir("raw", r.table))[0] == 1 for r in runs[0])
    # A load replayed after others have followed is still known, even if it stopped before the ledger.
    d = cfg.dataset_dir("raw", "public_orders")
    store.Files(spark, d).remove(f"{d}/{store.DONE}")
    ingest.ingest(spark, rows, cfg, only=["orders"], load_id="L2")
    ingest.ingest(spark, rows, cfg, only=["orders"], load_id="L1")
    assert store.current(spark, d)[0] == 2 and ingest.read_load_log(spark, cfg).count() == 3


def test_types_widen_over_three_loads(spark, tmp_root):
    d = f"{tmp_root}/w"
    ingest.merge_load(_table(spark, [(k, k, 1.5) for k in range(40)], "id int, n int, p float"), d, ["id"], "L1", buckets=8)
    ingest.merge_load(_table(spark, [(1, 2**40, 0.1)], "id bigint, n bigint, p double"), d, ["id"], "L2")
    last, _ = ingest.merge_load(_table(spark, [(2, "many", 2.5)], "id bigint, n string, p double"), d, ["id"], "L3")
    df = store.read_current(spark, d)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema if f.name[0] != "_"] == [("id", "bigint"), ("n", "bigint"), ("p", "double"), ("n__string", "string")]
    assert got(df.where("id < 4"), "id", "n", "p", "n__string") == [(0, 0, 1.5, None), (1, 2**40, 0.1, None), (2, None, 2.5, "many"), (3, 3, 1.5, None)]
    assert df.count() == 40 and len(store.manifest(spark, d, last).schemas) == 3
    with pytest.raises(TypeError):
        ingest.merge_load(_table(spark, [("x", 1)], "id string, n int"), d, ["id"], "L4")


def test_common_types():
    d = T.DecimalType
    cases = [(T.IntegerType(), T.LongType(), T.LongType()), (T.LongType(), d(10, 2), d(21, 2)), (d(10, 2), d(8, 6), d(14, 6)),
             (d(38, 0), d(10, 2), None), (T.FloatType(), T.DoubleType(), T.DoubleType()), (T.IntegerType(), T.DoubleType(), T.DoubleType()),
             (T.LongType(), T.DoubleType(), None), (T.DateType(), T.TimestampType(), T.TimestampType()), (T.StringType(), T.LongType(), None),
             (T.NullType(), T.DateType(), T.DateType()), (T.TimestampType(), T.TimestampNTZType(), None)]
    for a, b, want in cases:
        assert common_type(a, b) == common_type(b, a) == want


def test_second_column_of_a_name_widens_by_itself(spark):
    a = T.StructType.fromDDL("k int, x int, x__string string")
    schema, renamed = merged_schema(a, T.StructType.fromDDL("k bigint, x string"), ["k"])
    assert renamed == {"x": "x__string"} and schema["k"].dataType == T.LongType()
    assert got(conform(_table(spark, [(1, "t")], "k bigint, x string"), schema, renamed), "k", "x", "x__string") == [(1, None, "t")]


def test_expiry_keeps_pins_and_shared_buckets(spark, tmp_root):
    d = f"{tmp_root}/x"
    versions = [ingest.merge_load(_table(spark, [(k, "a") for k in range(200)]), d, ["id"], "L0", buckets=8)[0]]
    for n in range(1, 5):
        versions.append(ingest.merge_load(_table(spark, [(n, f"n{n}")]), d, ["id"], f"L{n}")[0])
    want = {v: got(store.read_version(spark, d, v), "id", "v") for v in versions}
    name = store.pin(spark, d, versions[1])
    assert store.expire(spark, d, keep=2) == [versions[2], versions[0]]
    for v in (versions[1], *versions[3:]):
        assert got(store.read_version(spark, d, v), "id", "v") == want[v]
    files = store.Files(spark, d)
    assert store.manifest(spark, d, versions[0]) is None and store.manifest(spark, d, versions[2]) is None
    assert not files.exists(f"{d}/{store.folders(spark, d, versions[1])[0]}/none")
    # A stale writer is still refused; a replay of a removed load is still known.
    with pytest.raises(store.Conflict):
        store.publish(spark, d, store.write_version(_table(spark, [(9, "z")]), d), 1)
    assert ingest.merge_load(_table(spark, [(0, "again")]), d, ["id"], "L0") == (versions[0], 200)
    store.unpin(spark, d, name)
    assert store.expire(spark, d, keep=1) == [versions[3], versions[1]]
    assert got(store.read_current(spark, d), "id", "v") == want[versions[4]]
    assert store.expire(spark, d, keep=1) == []


def test_versions_are_written_with_an_entropy_coder(spark, tmp_root):
    import glob

    store.write_version(spark.range(10).selectExpr("id", "md5(string(id)) as h"), f"{tmp_root}/z")
    names = glob.glob(f"{tmp_root}/z/*/*.parquet")
    assert names and all(".zstd." in n for n in names)


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_writes_and_loads_leave_no_shuffle_files(spark, tmp_root):
    import time

    from cadence.plans.concurrent import RELEASE, shuffles_released

    before, setting = _shuffle_files(spark), spark.conf.get(RELEASE, None)
    grouped = spark.range(5000).selectExpr("id % 100 as id", "id as n").groupBy("id").sum("n")
    store.write_version(grouped, f"{tmp_root}/grouped", ["id"])
    batch = spark.range(3000).selectExpr("id", "string(id) as v")
    ingest.merge_load(batch, f"{tmp_root}/merged", ["id"], "L0")
    ingest.merge_load(batch.where("id < 10"), f"{tmp_root}/merged", ["id"], "L1")
    until = time.time() + 10
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    with shuffles_released(spark), shuffles_released(spark):
        assert spark.conf.get(RELEASE) == "true"
    assert spark.conf.get(RELEASE, None) == setting


def test_dealt_rows_are_written_where_they_lie(spark, tmp_root):
    import glob

    rows = spark.range(0, 100, 1, 2).selectExpr("id % 2 as g", "99 - id as o")
    for name, dealt, files in (("dealt", True, 4), ("not", False, 2)):
        version = store.write_version(rows, f"{tmp_root}/{name}", ["g"], dealt=dealt, sort_by=["o"])
        found = glob.glob(f"{tmp_root}/{name}/{version}/*/*.parquet")
        assert len(found) == files
        for path in found:
            read = [r["o"] for r in spark.read.parquet(path).collect()]
            assert read == sorted(read)
