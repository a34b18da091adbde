"""Row-count reconciliation checks (I11) on seeded count tables."""

from cadence.sources import reconcile

SCHEMA = "table_name string, n bigint"


def test_checks_equal_gap_and_missing_sides(spark):
    source = spark.createDataFrame([("t_equal", 5), ("t_gap", 7), ("t_no_dest", 3)], SCHEMA)
    emitted = spark.createDataFrame([("t_equal", 5), ("t_gap", 6), ("t_no_source", 2),
                                     ("t_no_dest", 3)], SCHEMA)
    stored = spark.createDataFrame([("t_equal", 5), ("t_gap", 6), ("t_no_source", 2)], SCHEMA)
    labels = spark.createDataFrame([("t_equal", "replace (full refresh)")],
                                   "table_name string, load_strategy string")
    got = {
        (r["table_name"], r["check_name"]): (r["passed"], r["delta"], r["severity"])
        for r in reconcile.checks(source, emitted, stored, labels).collect()
    }
    src, dst = reconcile.SOURCE_CHECK, reconcile.STORED_CHECK
    assert got[("t_equal", src)] == (True, 0, "WARN")
    assert got[("t_equal", dst)] == (True, 0, "WARN")
    assert got[("t_gap", src)] == (False, 1, "WARN")
    assert got[("t_gap", dst)] == (True, 0, "WARN")
    assert got[("t_no_source", src)] == (False, None, "WARN")
    assert got[("t_no_dest", dst)] == (False, None, "WARN")
