"""Seeded-violation tests for D1-D9 and the folded suite report."""

from decimal import Decimal

from cadence.operators import quality as q


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_unique_reports_duplicates_and_lets_nulls_pass(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k bigint")
    assert rows(q.unique(df, "k"), "k", "n_records") == [(1, 2)]


def test_unique_combination_groups_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, None), (None, None)],
                               "a bigint, b bigint")
    got = rows(q.unique_combination(df, ["a", "b"]), "a", "b", "n_records")
    assert sorted(got, key=str) == sorted([(1, 1, 2), (None, None, 2)], key=str)


def test_not_null(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id bigint, v string")
    assert rows(q.not_null(df, "v"), "id") == [(2,)]


def test_relationships_orphan_reported_null_passes(spark):
    child = spark.createDataFrame([(1,), (2,), (9,), (9,), (None,)], "pid bigint")
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    got = rows(q.relationships(child, "pid", parent, "id"), "pid", "n_records")
    assert got == [(9, 2)]


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([(1,), (4,), (5,), (5,), (None,)], "s bigint")
    assert rows(q.accepted_values(df, "s", (1, 2, 3, 4)), "s", "n_records") == [(5, 2)]


def test_accepted_range_bounds(spark):
    df = spark.createDataFrame(
        [(0, Decimal("1.0")), (1, Decimal("1.01")), (None, None), (2, Decimal("0"))],
        "q bigint, d decimal(9,4)",
    )
    strict = q.accepted_range(df, "q", 0, None, inclusive=False)
    assert rows(strict, "q") == [(0,)]
    inclusive = q.accepted_range(df, "q", 0)
    assert rows(inclusive, "q") == []
    closed = q.accepted_range(df, "d", 0, 1)
    assert rows(closed, "d") == [(Decimal("1.0100"),)]


def _orders_and_lines(spark):
    orders = spark.createDataFrame(
        [(1, Decimal("10.00")), (2, Decimal("10.00")), (3, Decimal("5.00"))],
        "order_id bigint, total_revenue decimal(38,2)",
    )
    lines = spark.createDataFrame(
        [(1, 1, 1, Decimal("10.01"), Decimal("0"), Decimal("10.01")),
         (2, 1, 1, Decimal("10.02"), Decimal("0"), Decimal("10.02")),
         (2, 2, 2, Decimal("1.00"), Decimal("0.5000"), Decimal("1.01")),
         (2, 3, 1, Decimal("1.00"), Decimal("0"), None)],
        "order_id bigint, item_id bigint, quantity bigint, list_price decimal(18,2), "
        "discount decimal(9,4), revenue decimal(18,2)",
    )
    return orders, lines


def test_revenue_reconciliation_tolerance_and_inner_join(spark):
    orders, lines = _orders_and_lines(spark)
    got = rows(q.revenue_reconciliation(orders, lines), "order_id")
    # order 1 differs by exactly 0.01 (passes), order 2 by 1.03, order 3 has no lines.
    assert got == [(2,)]


def test_revenue_formula_wrong_by_a_cent_null_passes(spark):
    _, lines = _orders_and_lines(spark)
    got = rows(q.revenue_formula(lines), "order_id", "item_id", "expected_revenue")
    assert got == [(2, 2, Decimal("1.00"))]


def test_shipped_before_ordered(spark):
    import datetime as dt

    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 2), dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 2), None),
         (3, dt.date(2020, 1, 2), dt.date(2020, 1, 3))],
        "order_id bigint, order_date date, shipped_date date",
    )
    assert rows(q.shipped_before_ordered(df), "order_id") == [(1,)]


def test_declared_suite_has_115_generic_tests():
    from collections import Counter

    kinds = Counter(e.kind for e in q.DECLARED)
    assert len(q.DECLARED) == 115
    assert kinds == {"not_null": 47, "relationships": 22, "accepted_range": 19, "unique": 18,
                     "unique_combination": 7, "accepted_values": 2}


def test_folded_report_counts_each_test(spark):
    child = spark.createDataFrame([(1, 5, None), (1, 2, 7), (2, 9, 3)],
                                  "k bigint, s bigint, parent bigint")
    parent = spark.createDataFrame([(3,)], "id bigint")
    tests = [
        q.Expectation("child", "unique", ("k",)),
        q.Expectation("child", "not_null", ("parent",)),
        q.Expectation("child", "accepted_values", ("s",), {"values": (1, 2, 3, 4)}),
        q.Expectation("child", "accepted_range", ("s",), {"min": 0, "max": 4, "inclusive": True}),
        q.Expectation("child", "relationships", ("parent",), {"to": "parent", "field": "id"}),
        q.Expectation("child", "unique_combination", ("k", "s")),
    ]
    report = q.evaluate({"child": child, "parent": parent}, tests, singular=[])
    got = {r["test_type"]: (r["n_violations"], r["passed"]) for r in report.collect()}
    assert got == {
        "unique": (1, False),
        "not_null": (1, False),
        "accepted_values": (2, False),
        "accepted_range": (2, False),
        "relationships": (1, False),
        "unique_combination": (0, True),
    }


def test_text_keys_are_settled_by_their_hashes_only_where_none_comes_twice(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), (None, "y", 3), (None, None, 3)],
                               "k string, twice string, n bigint")
    tests = [q.Expectation("t", "unique", (c,)) for c in ("k", "twice", "n")]
    tests += [q.Expectation("t", "unique_combination", ("k", "n"))]
    assert [e.columns for e in q._settled_by_hash(df, tests)] == [("k",)]
    exact = q.evaluate({"t": df}, tests, []).collect()
    hashed = q.evaluate({"t": df}, tests, [], hashed=True)
    assert sorted(map(tuple, hashed.collect())) == sorted(map(tuple, exact))
    assert {r["test_name"]: r["n_violations"] for r in exact} == {
        "unique_t_k": 0, "unique_t_twice": 1, "unique_t_n": 1, "unique_combination_t_k_n": 1}
    # Of a key that is settled, the text is in no shuffle any more.
    plan = q.evaluate({"t": df}, tests[:1], [], hashed=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan
    assert q.evaluate({"t": df.limit(0)}, tests, [], hashed=True).where("not passed").count() == 0
