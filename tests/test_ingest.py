"""Upsert, replace, lineage and schema evolution (I4-I7) on seeded frames."""

import pytest

from cadence.sources import ingest, store


def _table(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v string")


def sorted_rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_insert_update_keep(spark):
    current = _table(spark, [(1, "a"), (2, "b"), (3, "c")])
    batch = _table(spark, [(2, "B"), (4, "d")])
    merged = ingest.upsert(current, batch, ["id"], seq=None)
    assert sorted_rows(merged, "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_duplicate_key_in_batch_latest_sequence_wins(spark):
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)],
                                  "id bigint, v string, _seq int")
    merged = ingest.upsert(None, batch, ["id"])
    assert sorted_rows(merged, "id", "v", "_seq") == [(1, "new", 2), (2, "x", 1)]


def test_late_older_change_does_not_overwrite(spark):
    schema = "id bigint, v string, _seq int"
    current = spark.createDataFrame([(1, "v2", 2), (2, "b", 1)], schema)
    batch = spark.createDataFrame([(1, "v1-late", 1), (2, "b2", 1)], schema)
    merged = ingest.upsert(current, batch, ["id"], tiebreak=[])
    # id 1: the stored change is newer; id 2: equal sequence, both versions
    # compete and the choice is deterministic.
    got = dict(sorted_rows(merged, "id", "v"))
    assert got[1] == "v2"
    assert merged.count() == 2


def test_upsert_is_idempotent_and_key_unique(spark):
    current = _table(spark, [(1, "a"), (2, "b")])
    batch = _table(spark, [(2, "B"), (3, "c")])
    once = ingest.upsert(current, batch, ["id"], seq=None)
    twice = ingest.upsert(once, batch, ["id"], seq=None)
    assert sorted_rows(once, "id", "v") == sorted_rows(twice, "id", "v")
    assert once.groupBy("id").count().where("count > 1").count() == 0


def test_composite_key_merge_load_versions(spark, tmp_root):
    d = f"{tmp_root}/t"
    first = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (2, 1, 30)],
                                  "order_id bigint, item_id bigint, qty bigint")
    v1, n1 = ingest.merge_load(first, d, ["order_id", "item_id"], "L1")
    batch = spark.createDataFrame([(1, 2, 21), (3, 1, 40)],
                                  "order_id bigint, item_id bigint, qty bigint")
    v2, n2 = ingest.merge_load(batch, d, ["order_id", "item_id"], "L2")
    assert (n1, n2) == (3, 2)
    cur = store.read_current(spark, d)
    assert sorted_rows(cur, "order_id", "item_id", "qty") == [
        (1, 1, 10), (1, 2, 21), (2, 1, 30), (3, 1, 40)
    ]
    # The previous version is untouched.
    assert store.read_version(spark, d, v1).count() == 3
    v3, _ = ingest.merge_load(batch, d, ["order_id", "item_id"], "L2")
    assert sorted_rows(store.read_current(spark, d), "order_id", "item_id", "qty") == sorted_rows(
        cur, "order_id", "item_id", "qty")


def test_replace_load_is_idempotent(spark, tmp_root):
    d = f"{tmp_root}/r"
    df = _table(spark, [(1, "a"), (2, "b")])
    ingest.replace_load(df, d, ["id"], "L1")
    ingest.replace_load(df, d, ["id"], "L2")
    assert sorted_rows(store.read_current(spark, d), "id", "v") == [(1, "a"), (2, "b")]


def test_lineage_is_deterministic(spark):
    import hashlib

    df = _table(spark, [(7, "a")])
    r = ingest.add_lineage(df, ["id"], "load-1").first()
    assert r["_load_id"] == "load-1"
    assert r["_row_id"] == hashlib.sha256(b"7|load-1").hexdigest()


def test_schema_evolution_adds_columns(spark, tmp_root):
    d = f"{tmp_root}/e"
    ingest.merge_load(_table(spark, [(1, "a"), (2, "b")]), d, ["id"], "L1")
    wider = spark.createDataFrame([(2, "B", 5)], "id bigint, v string, extra bigint")
    ingest.merge_load(wider, d, ["id"], "L2")
    got = sorted_rows(store.read_current(spark, d), "id", "v", "extra")
    assert got == [(1, "a", None), (2, "B", 5)]


def test_current_version_missing_is_none(spark, tmp_root):
    assert store.current_version(spark, f"{tmp_root}/none") is None


def test_null_key_parts_are_equal_and_loads_repeat(spark, tmp_root):
    d = f"{tmp_root}/n"
    rows = spark.createDataFrame([(1, "a"), (None, "n"), (None, "m")], "id bigint, v string")
    emitted = [ingest.merge_load(rows, d, ["id"], f"L{k}")[1] for k in range(3)]
    assert emitted == [3, 3, 3]  # what the batch held, before de-duplication
    got = sorted(((r["id"], r["v"]) for r in store.read_current(spark, d).collect()), key=str)
    assert got == [(1, "a"), (None, "n")]


def test_late_rows_are_emitted_and_do_not_win(spark, tmp_root):
    d = f"{tmp_root}/l"
    schema = "id bigint, v string, _seq int"
    ingest.merge_load(spark.createDataFrame([(1, "new", 2)], schema), d, ["id"], "L1")
    batch = spark.createDataFrame([(1, "late", 1), (2, "b", 1)], schema)
    assert ingest.merge_load(batch, d, ["id"], "L2")[1] == 2
    assert sorted_rows(store.read_current(spark, d), "id", "v") == [(1, "new"), (2, "b")]


def test_batch_is_read_once(spark, tmp_root):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r

    schema = "id bigint, v string, _seq int"
    rows = spark.sparkContext.parallelize([(1, "a", 1), (2, "b", 1)], 1).mapPartitions(count)
    batch = spark.createDataFrame(rows, schema)
    ingest.merge_load(batch, f"{tmp_root}/once", ["id"], "L1")
    ingest.merge_load(batch, f"{tmp_root}/once", ["id"], "L2")
    assert seen.value == 4


def test_second_writer_from_one_version_is_refused(spark, tmp_root):
    d = f"{tmp_root}/c"
    ingest.merge_load(_table(spark, [(1, "a")]), d, ["id"], "L1")
    number, _ = store.current(spark, d)
    mine = store.write_version(_table(spark, [(1, "mine")]), d)
    store.publish(spark, d, store.write_version(_table(spark, [(1, "theirs")]), d), number)
    with pytest.raises(store.Conflict):
        store.publish(spark, d, mine, number)
    assert sorted_rows(store.read_current(spark, d), "id", "v") == [(1, "theirs")]


def _dealt(monkeypatch):
    """The rows that merge loads give to the shuffle into buckets."""
    seen, write = [], store.write_buckets
    monkeypatch.setattr(store, "write_buckets", lambda df, *a, **k: seen.append(df) or write(df, *a, **k))
    return seen


def test_row_ids_are_made_after_the_shuffle(spark, tmp_root, monkeypatch):
    import hashlib

    seen, d = _dealt(monkeypatch), f"{tmp_root}/ids"
    kinds = "a bigint, b bigint, v string"
    ingest.merge_load(spark.createDataFrame([(1, None, "x"), (2, 2, "y")], kinds), d, ["a", "b"], "L1")
    ingest.merge_load(spark.createDataFrame([(1, None, "z"), (3, 3, "n")], kinds), d, ["a", "b"], "L2")
    assert all("_row_id" not in df.columns for df in seen)
    got = store.read_current(spark, d)
    assert got.columns == ["a", "b", "v", "_load_id", "_row_id"]
    expected = {(v, hashlib.sha256(t).hexdigest()) for v, t in (("z", b"1||L2"), ("y", b"2|2|L1"), ("n", b"3|3|L2"))}
    assert {(r.v, r._row_id) for r in got.collect()} == expected


def test_row_ids_keep_the_text_that_a_key_had(spark, tmp_root):
    import hashlib

    d = f"{tmp_root}/text"
    ingest.merge_load(spark.createDataFrame([(1, "a")], "id bigint, v string"), d, ["id"], "L1")
    cents = spark.createDataFrame([("2.50", "b")], "id string, v string").selectExpr("cast(id as decimal(10,2)) as id", "v")
    ingest.merge_load(cents, d, ["id"], "L2")
    ids = {r.v: r._row_id for r in store.read_current(spark, d).collect()}
    assert ids == {"a": hashlib.sha256(b"1|L1").hexdigest(), "b": hashlib.sha256(b"2.50|L2").hexdigest()}


def test_only_batches_with_a_key_twice_are_deduplicated(spark, tmp_root, monkeypatch):
    seen, d = _dealt(monkeypatch), f"{tmp_root}/once"
    ingest.merge_load(_table(spark, [(1, "a"), (2, "b")]), d, ["id"], "L1")
    ingest.merge_load(_table(spark, [(2, "c"), (2, "d"), (3, "e")]), d, ["id"], "L2")
    ingest.merge_load(_table(spark, []), d, ["id"], "L3")
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in seen]
    assert ["Aggregate" in p for p in plans] == [False, True, False]
    assert sorted_rows(store.read_current(spark, d), "id", "v") == [(1, "a"), (2, "d"), (3, "e")]


def test_a_first_load_adds_its_load_id_after_the_rows_are_dealt(spark, tmp_root, monkeypatch):
    dealt, write = [], store.write_buckets
    monkeypatch.setattr(store, "write_buckets", lambda df, *a: (dealt.append(df.columns), write(df, *a))[1])
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id bigint, v string")
    for load_id in ("one", "two"):
        version, emitted = ingest.merge_load(batch, f"{tmp_root}/t", ["id"], load_id)
        table = store.read_version(spark, f"{tmp_root}/t", version)
        assert table.columns == ["id", "v", "_load_id", "_row_id"] and emitted == 3
        assert sorted((r["id"], r["_load_id"]) for r in table.collect()) == [(1, load_id), (2, load_id)]
    assert "_load_id" not in dealt[0] and "_load_id" in dealt[1]
