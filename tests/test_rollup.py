"""Questions answered from the rollup equal those over the lines."""

import pytest

from cadence import queries
from cadence.operators import kpi, rollup
from cadence.sources import store
from tests.conftest import SF_SMALL
from tests.test_plans import plan_of


@pytest.fixture(scope="module")
def tables(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="cadence-rollup-")
    sales = store.write_and_publish(queries.workspace(spark, SF_SMALL)["rpt_sales"], f"{root}/sales")
    return sales, store.write_and_publish(rollup.sales_rollup(sales), f"{root}/rollup", [rollup.GRAIN])


@pytest.mark.parametrize("question", sorted(rollup.QUESTIONS))
def test_same_answer_as_over_the_lines(tables, question):
    sales, stored = tables
    want, got = rollup.QUESTIONS[question][1](sales), rollup.answer(stored, question)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_one_scan_of_the_lines_and_one_grain_per_question(tables):
    sales, stored = tables
    plan = plan_of(rollup.sales_rollup(sales))
    assert plan.count("FileScan parquet") == 1 and "partial_sum" in plan
    plan = plan_of(rollup.answer(stored, "kpi_revenue_state"))
    assert "PartitionFilters: [isnotnull(grain" in plan
    orders = rollup.at_grain(stored, rollup.ORDER)
    assert orders.count() == orders.select("order_id").distinct().count() == sales.select("order_id").distinct().count()


def test_filters_of_the_grain_only(tables):
    sales, stored = tables
    wanted = {"store_state": "EUROPE"}
    assert rollup.answer(stored, "kpi_revenue_state", wanted).collect() == kpi.revenue_state(sales, wanted).collect()
    with pytest.raises(ValueError):
        rollup.answer(stored, "kpi_revenue_state", {"brand_name": "Brand#11"})


def test_nulls_and_no_lines(tables, spark):
    sales, _ = tables
    assert rollup.report(rollup.sales_rollup(sales.limit(0))).count() == 0
    none = sales.limit(5).selectExpr(*[f"cast(null as {t}) as {c}" for c, t in sales.dtypes])
    (row,) = rollup.answer(rollup.sales_rollup(none), "kpi_revenue_state").collect()
    assert (row.store_state, row.n_lines, row.n_orders) == (None, 5, 0)
