"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

# The training-data queries are tested in tests/llm.
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"create view {name} as select * from "
                    f"read_parquet('{os.path.join(SF_SMALL, name)}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    spark_cols = df.columns
    spark_rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert spark_rows is not None
        return
    cur = duck.execute(sql)
    duck_cols = [c[0] for c in cur.description]
    duck_rows = cur.fetchall()
    assert sorted(spark_cols) == sorted(duck_cols)
    assert len(spark_rows) == len(duck_rows)
    assert _rows(spark_rows, spark_cols) == _rows(duck_rows, duck_cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns
