"""The partitioned JDBC scan asks Spark for the right reads (no database
may run here, so ``spark.read.jdbc`` is recorded instead of executed)."""

import datetime as dt
import random
import re
from bisect import bisect_left
from collections import Counter
from statistics import median

import pytest

from cadence.sources import jdbc


class _Reader:
    """Answers the bounds and, from the keys it is given, the counts of bins."""

    def __init__(self, bounds, keys=()):
        self.calls, self.bounds, self.keys = [], bounds, sorted(keys)

    def jdbc(self, url, table, **kwargs):
        self.calls.append((url, table, kwargs))
        reader = self

        class _Frame:
            def first(self):
                return reader.bounds

            def collect(self):
                low, step, high = (int(x) for x in re.search(r"- (-?\d+)\) / (\d+)\.0\) as bin.* < (-?\d+) group", table).groups())
                inside = reader.keys[bisect_left(reader.keys, low) : bisect_left(reader.keys, high)]
                return [{"bin": b, "n": n} for b, n in Counter((k - low) // step for k in inside).items()]

        return _Frame()


class _Spark:
    def __init__(self, bounds, keys=()):
        self.read = _Reader(bounds, keys)


def _read(keys, column="order_id", **options):
    spark = _Spark({"n": len(keys), "lo0": min(keys), "hi0": max(keys)}, keys)
    jdbc.read_table(spark, "jdbc:x", "public", "orders", {}, [column], rows_per_partition=1000, **options)
    return spark.read.calls


def _rows(predicates, keys):
    """Rows of each range predicate; every key is in one."""
    def holds(p, k):
        return eval(p.replace('"order_id"', "k").replace(" or k is null", ""), {"k": k})

    counts = [sum(holds(p, k) for k in keys) for p in predicates]
    assert sum(counts) == len(keys)
    return counts


DENSE = list(range(20_000))
GAPS = [k * k * k for k in range(-200, 15_000)]
SKEWED = sorted({int(random.Random(k).expovariate(1e-4)) + (10**12 if k % 3 else 0) for k in range(30_000)})


@pytest.mark.parametrize("keys", [DENSE, GAPS, SKEWED, [-5, 10**15] + list(range(10**9, 10**9 + 9000))])
def test_ranges_have_equal_depth(keys):
    *_, (_, table, last) = calls = _read(keys)
    counts = _rows(last["predicates"], keys)
    assert table == '"public"."orders"' and max(counts) <= 1000 + 1
    assert max(counts) <= 2 * median(counts) and len(counts) <= 2.2 * len(keys) / 1000 + 2
    assert len(calls) < 40 and '"order_id" is null' in last["predicates"][0]


def test_pushdown_properties_and_bounds_query():
    spark = _Spark({"n": 3000, "lo0": 0, "hi0": 2999}, range(3000))
    jdbc.read_table(spark, "jdbc:postgresql://db/x", "public", "orders",
                    {"user": "u", "pushDownPredicate": "false"}, ["order_id"], rows_per_partition=1000)
    (_, bounds_sql, _), *_, (_, table, last) = spark.read.calls
    assert 'min("order_id")' in bounds_sql and '"public"."orders"' in bounds_sql
    assert table == '"public"."orders"' and len(last["predicates"]) in (3, 4)
    props = last["properties"]
    assert props["user"] == "u" and props["pushDownAggregate"] == "true"
    assert props["fetchsize"] == "10000"
    assert props["pushDownPredicate"] == "false"  # the caller's setting wins


def test_partitions_follow_the_rows_and_the_caller_bounds_connections():
    assert len(_read(DENSE)[-1][2]["predicates"]) >= 20
    assert len(_read(DENSE, max_partitions=4)[-1][2]["predicates"]) <= 9
    assert "predicates" not in _read(DENSE, max_partitions=1)[-1][2]


def test_widest_key_column_is_split():
    spark = _Spark({"n": 20_000, "lo0": 1, "hi0": 25, "lo1": 1, "hi1": 20_000}, range(1, 20_001))
    jdbc.read_table(spark, "jdbc:x", "public", "stocks", {}, ["store_id", "product_id"], rows_per_partition=1000)
    assert all('"product_id"' in p for p in spark.read.calls[-1][2]["predicates"])


def test_dates_are_bounds_and_text_keys_are_hashed():
    spark = _Spark({"n": 5_000_000, "lo0": dt.date(2020, 1, 1), "hi0": dt.date(2021, 1, 1)})
    jdbc.read_table(spark, "jdbc:x", "public", "days", {}, ["day"])
    assert spark.read.calls[-1][2]["lowerBound"] == "2020-01-01"
    spark = _Spark({"n": 5_000_000, "lo0": "a", "hi0": "z"})
    jdbc.read_table(spark, "jdbc:x", "public", 'odd"name', {}, ["code"])
    _, table, last = spark.read.calls[-1]
    assert table == '"public"."odd""name"' and len(last["predicates"]) == 5
    assert last["predicates"][0] == 'mod(abs(hashtext("code")::bigint), 5) = 0 or "code" is null'
    assert last["predicates"][4] == 'mod(abs(hashtext("code")::bigint), 5) = 4'


def test_small_or_empty_tables_read_in_one_partition():
    for found in ({"n": 0, "lo0": None, "hi0": None}, {"n": 900, "lo0": 1, "hi0": 900}):
        spark = _Spark(found)
        jdbc.read_table(spark, "jdbc:x", "public", "brands", {}, ["brand_id"])
        assert "column" not in spark.read.calls[-1][2]
