"""Gated build (I15): an error blocks descendants, a WARN does not."""

import pytest

from cadence.config import Config
from cadence.operators.quality import WARN, Expectation
from cadence.plans.build import ERROR, FAILED, SKIPPED, SUCCESS, WARNED, build
from cadence.sources import ingest, store
from cadence.sources.fixtures import raw_tables
from tests.conftest import SF_SMALL


def _loaded(spark, tmp_root, cfg):
    ingest.ingest(spark, raw_tables(spark, SF_SMALL), cfg)
    return ingest.LoadedRaw(spark, cfg)


def test_declared_suite_gates_descendants(spark, tmp_root):
    # Default 2016-2019 calendar: every fixture order date misses it, so
    # fct_order_items fails its order_date relationship test; fct_orders
    # fails the shipped-after-order business test.
    cfg = Config(root=tmp_root)
    raw = _loaded(spark, tmp_root, cfg)
    result = build(spark, raw, cfg)
    assert result.status("fct_order_items") == FAILED
    assert result.status("fct_orders") == FAILED
    assert result.status("rpt_sales") == SKIPPED
    assert result.status("rpt_orders") == SKIPPED
    assert result.status("rpt_stocks") == SUCCESS
    # A failed table is not published; a passing one is.
    assert not store.exists(spark, cfg.dataset_dir("marts", "fct_orders"))
    assert store.read_current(spark, cfg.dataset_dir("marts", "fct_stocks")).count() > 0
    report = {r["dataset"]: r["status"] for r in result.report(spark).collect()}
    assert report["rpt_orders"] == SKIPPED


def test_warn_does_not_block_and_selection(spark, tmp_root):
    cfg = Config(root=tmp_root).with_fixture_calendar()
    raw = _loaded(spark, tmp_root, cfg)
    warn_only = [Expectation("fct_orders", "accepted_range", ("shipping_days",),
                             {"min": 0, "max": None, "inclusive": True}, severity=WARN)]
    result = build(spark, raw, cfg, suite=warn_only, singular=False)
    assert result.status("fct_orders") == WARNED
    assert result.status("rpt_orders") == SUCCESS
    published = store.read_current(spark, cfg.dataset_dir("reporting", "rpt_orders"))
    assert published.count() == result.workspace["fct_orders"].count()
    # Partial rebuild: only the reporting layer, reading published marts.
    again = build(spark, raw, cfg, select=["reporting"], suite=[], singular=False)
    assert [d.dataset for d in again.datasets] == ["rpt_sales", "rpt_orders", "rpt_stocks"]
    assert all(d.status == SUCCESS for d in again.datasets)


def test_tests_only_rerun_reads_published_tables(spark, tmp_root):
    cfg = Config(root=tmp_root).with_fixture_calendar()
    raw = _loaded(spark, tmp_root, cfg)
    marts = ["dim_stores", "dim_customers"]
    first = build(spark, raw, cfg, select=marts)
    assert all(d.status == SUCCESS for d in first.datasets)
    version = store.current_version(spark, cfg.dataset_dir("marts", "dim_stores"))
    again = build(spark, raw, cfg, select=marts, tests_only=True)
    assert [d.n_tests for d in again.datasets] == [2, 2]
    assert all(d.status == SUCCESS for d in again.datasets)
    # Nothing was written: the published version is unchanged.
    assert store.current_version(spark, cfg.dataset_dir("marts", "dim_stores")) == version


def test_refresh_loads_reconciles_and_builds(spark, tmp_root):
    from cadence.plans.refresh import refresh

    cfg = Config(root=tmp_root).with_fixture_calendar()
    result = refresh(spark, raw_tables(spark, SF_SMALL), cfg, select=["dim_stores"])
    assert len(result.loads) == 9 and len(result.checks) == 18
    assert result.warnings == []
    assert result.build.status("dim_stores") == SUCCESS
    log = ingest.read_load_log(spark, cfg).collect()
    assert len(log) == 9 and {r["load_id"] for r in log} == {result.loads[0].load_id}


def test_ci_prefix_writes_elsewhere_but_reads_the_same_raw(spark, tmp_root):
    prod = Config(root=tmp_root).with_fixture_calendar()
    loads = ingest.ingest(spark, raw_tables(spark, SF_SMALL), prod, only=["stores"])
    ci = prod.for_ci()
    result = build(spark, ingest.LoadedRaw(spark, ci), ci, select=["dim_stores"])
    assert result.status("dim_stores") == SUCCESS
    assert store.exists(spark, ci.dataset_dir("marts", "dim_stores"))
    assert not store.exists(spark, prod.dataset_dir("marts", "dim_stores"))
    assert ci.dataset_dir("raw", "public_stores") == prod.dataset_dir("raw", "public_stores")
    assert loads[0].emitted_rows == result.datasets[0].n_rows


def test_a_test_of_two_datasets_holds_back_both(spark, tmp_root):
    cfg = Config(root=tmp_root).with_fixture_calendar()
    raw = _loaded(spark, tmp_root, cfg)
    off = {"fct_order_items": lambda df: df.withColumn(
        "revenue", (df.revenue + 1).cast("decimal(18,2)"))}
    result = build(spark, raw, cfg, select=["marts", "reporting"], suite=[],
                   singular=["assert_order_revenue_reconciliation"], adjust=off)
    for name in ("fct_orders", "fct_order_items"):
        assert result.status(name) == FAILED
        assert not store.exists(spark, cfg.dataset_dir("marts", name))
    for name in ("rpt_sales", "rpt_orders"):
        assert result.status(name) == SKIPPED
    assert result.status("rpt_stocks") == SUCCESS


def test_an_error_is_a_status_and_stops_only_what_depends_on_it(spark, tmp_root):
    cfg = Config(root=tmp_root).with_fixture_calendar()
    raw = dict(raw_tables(spark, SF_SMALL))
    raw["customers"] = raw["customers"].selectExpr("* except (zip_code)", "'oops' as zip_code")
    chosen = ["dim_customers", "dim_stores", "fct_orders", "fct_stocks"]
    result = build(spark, raw, cfg, select=chosen, singular=False)
    assert result.status("dim_customers") == ERROR
    assert "oops" in next(d for d in result.datasets if d.dataset == "dim_customers").message
    assert result.status("dim_stores") == result.status("fct_stocks") == SUCCESS
    # Its foreign key to customers cannot be checked, so it is not published.
    assert result.status("fct_orders") == SKIPPED
    assert not store.exists(spark, cfg.dataset_dir("marts", "fct_orders"))


def test_kinds_of_tests_can_be_chosen(spark, tmp_root):
    from cadence.operators import quality

    generic, singular = quality.select_kinds(["test_type:singular"])
    assert not generic and len(singular) == 3
    generic, singular = quality.select_kinds(["unique", "generic"])
    assert len(generic) == 115 and not singular
    with pytest.raises(ValueError):
        quality.select_kinds(["nope"])
