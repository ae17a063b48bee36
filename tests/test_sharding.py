"""Time-block shards with halo rows give exactly the unsharded results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from heliospark.operators import timeseries as TS
from heliospark.plans import q_features as Q
from heliospark.plans.common import sites_grid


def _same(a, b, key=("city", "ts")):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    ra = sorted(a.select(*cols).collect(), key=lambda r: tuple(r[k] for k in key))
    rb = sorted(b.select(*cols).collect(), key=lambda r: tuple(r[k] for k in key))
    assert ra == rb


def test_sharded_imputation_is_identical(spark):
    grid = sites_grid(spark, SMALL)
    _same(TS.impute(grid, Q.IMP), TS.impute(grid, Q.IMP, shard_hours=200))


def test_sharded_features_are_identical(spark):
    imp = TS.impute(sites_grid(spark, SMALL), Q.IMP).select("city", "ts", "i", "ghi", "temp")
    chain = TS.with_targets(TS.with_rolling(TS.with_lags(TS.with_cyclical(imp))))
    _same(chain, TS.with_features(imp))
    _same(chain, TS.with_features(imp, shard_hours=50))


def test_sharded_windows_partition_by_block(spark):
    grid = sites_grid(spark, SMALL)
    plan = TS.impute(grid, Q.IMP, shard_hours=200)._jdf.queryExecution().executedPlan().toString()
    assert "_blk" in plan


def test_halo_longer_than_block_is_rejected(spark):
    with pytest.raises(ValueError):
        TS.shard_blocks(sites_grid(spark, SMALL).select("city", "ts", "i"), 24, 48, 1)
