"""Table selection (I2), naming (I3), namespacing (I14), dataset graph (I16)."""

import pytest

from cadence.catalog import select_tables
from cadence.config import Config
from cadence.plans.build import resolve_selection
from cadence.plans.datasets import REGISTRY, descendants, topological_order


def test_select_tables_case_insensitive_keeps_catalogue_order():
    got = [t.name for t in select_tables(["Stocks", "ORDERS", "nope"])]
    assert got == ["orders", "stocks"]


def test_select_tables_all_unknown_is_an_error():
    with pytest.raises(ValueError):
        select_tables(["nope"])


def test_select_tables_default_is_all_nine():
    assert len(select_tables()) == 9


def test_destination_naming_and_layers():
    cfg = Config(root="/shared/x")
    assert cfg.raw_table_name("orders") == "public_orders"
    assert cfg.dataset_dir("marts", "fct_orders") == "/shared/x/retail_marts/fct_orders"
    ci = cfg.for_ci()
    assert ci.dataset_dir("marts", "fct_orders") == "/shared/x/retail_ci_marts/fct_orders"
    assert ci.layer_dir("raw") == cfg.layer_dir("raw")


def test_calendar_range_is_a_parameter():
    assert Config().calendar_days == 1461
    assert Config().with_fixture_calendar().calendar_days == 2557


def test_graph_order_and_selection():
    order = topological_order()
    assert order.index("stg_orders") < order.index("fct_orders") < order.index("rpt_orders")
    assert set(resolve_selection(["reporting"])) == {"rpt_sales", "rpt_orders", "rpt_stocks"}
    assert resolve_selection(["fct_orders"]) == ["fct_orders"]
    assert "rpt_orders" in descendants("fct_orders")
    assert {d.layer for d in REGISTRY.values()} == {"staging", "intermediate", "marts",
                                                     "reporting"}


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_without_a_shared_folder_is_an_error():
    from cadence.config import shared_dir

    with pytest.raises(RuntimeError):
        shared_dir(_Session())
