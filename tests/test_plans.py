"""Physical-plan properties: pruning, pushdown, no global windows."""

from __future__ import annotations

import re

from conftest import SMALL
from heliospark.plans import catalog

catalog.load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_columns(spark):
    plan = _plan(catalog.QUERIES["daily_decision_summary"](spark, SMALL))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan) or re.search(r"struct<([^>]*)>", plan)
    assert schema is not None
    cols = {c.split(":")[0] for c in schema.group(1).split(",")}
    assert cols == {"event_type", "ts", "value", "props"}


def test_time_slice_filter_is_pushed_to_scan(spark):
    plan = _plan(catalog.QUERIES["incremental_slice"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(ts)" in plan or "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_no_single_partition_window_over_data(spark):
    # Windows must be partitioned; the only unpartitioned ones are over the
    # per-range-partition edge tables (one row per partition).
    # (Keyless aggregates still merge their partial rows in one partition.)
    unpartitioned = re.compile(r"Window \[.*\], \[\], \[")
    for name in ("impute_tiers", "feature_matrix", "daily_decision_summary", "kpi_row", "upsert_merge", "lags"):
        plan = _plan(catalog.QUERIES[name](spark, SMALL))
        bad = [ln for ln in plan.splitlines() if unpartitioned.search(ln)]
        assert not bad, (name, bad)


def test_city_windows_take_the_order_of_the_stored_grid(spark):
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    for name in ("lags", "rolling", "targets"):
        plan = _plan(catalog.QUERIES[name](spark, SMALL))
        assert "Bucketed: true" in plan and "Exchange" not in plan and "Sort [" not in plan, name
    for name in ("corr_matrix", "scaled_features", "feature_matrix"):
        plan = _plan(catalog.QUERIES[name](spark, SMALL))
        # Only the one-row result of a global aggregate is exchanged.
        assert "hashpartitioning" not in plan and "Sort [" not in plan, name


def test_grid_scans_once_without_a_join(spark):
    plan = _plan(catalog.QUERIES["hourly_grid"](spark, SMALL))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_backtest_reads_its_week_only(spark):
    plan = _plan(catalog.QUERIES["backtest_pairs"](spark, SMALL))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
