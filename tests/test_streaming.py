"""Micro-batch upsert of change files (streaming form of I5)."""

from cadence.sources import store
from cadence.streaming import change_stream, start_upsert_stream


def test_stream_upserts_each_batch(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    schema = "id bigint, v string, _seq int"
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema).write.parquet(f"{landing}/f1")
    spark.createDataFrame([(2, "B", 2), (3, "c", 2), (3, "c-old", 1)], schema).write.parquet(
        f"{landing}/f2")
    table = f"{tmp_root}/t"
    q = start_upsert_stream(change_stream(spark, f"{landing}/*", schema, 1), table, ["id"],
                            f"{tmp_root}/ckpt", name="t")
    q.awaitTermination()
    got = sorted(tuple(r) for r in store.read_current(spark, table).select("id", "v").collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]
