"""SURVEY §5 invariants on the fixture build: left joins do not fan out,
and the two business tests that must hold on clean data find nothing."""

import pytest

from cadence.operators import quality
from cadence.queries import workspace
from tests.conftest import SF_SMALL

# dataset -> its left-most input
LEFT_MOST = {
    "int_order_items_enriched": "stg_order_items",
    "fct_order_items": "stg_order_items",
    "fct_orders": "stg_orders",
    "fct_stocks": "stg_stocks",
    "dim_customers": "stg_customers",
    "dim_products": "stg_products",
    "dim_staffs": "stg_staffs",
    "dim_stores": "stg_stores",
    "rpt_sales": "fct_order_items",
    "rpt_orders": "fct_orders",
    "rpt_stocks": "fct_stocks",
}


@pytest.fixture(scope="module")
def ws(spark):
    return workspace(spark, SF_SMALL)


@pytest.mark.parametrize("name", sorted(LEFT_MOST))
def test_row_count_equals_left_most_input(ws, name):
    assert ws[name].count() == ws[LEFT_MOST[name]].count()


def test_revenue_reconciliation_and_formula_hold(ws):
    assert quality.revenue_reconciliation(ws["fct_orders"], ws["fct_order_items"]).count() == 0
    assert quality.revenue_formula(ws["fct_order_items"]).count() == 0


def test_dimension_keys_are_unique(ws):
    for name, key in (("dim_products", "product_id"), ("dim_customers", "customer_id"),
                      ("dim_staffs", "staff_id"), ("dim_stores", "store_id"),
                      ("dim_date", "date_day")):
        assert quality.unique(ws[name], key).count() == 0, name
