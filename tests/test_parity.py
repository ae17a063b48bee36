"""Every registered plan with an oracle equals its DuckDB SQL exactly."""

from __future__ import annotations

import math

import pandas as pd
import pytest

from conftest import SMALL
from heliospark.plans import catalog

catalog.load_all()
NAMES = sorted(catalog.ORACLES)


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)]
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return cols, sorted(rows, key=key)


@pytest.mark.parametrize("name", NAMES)
def test_plan_matches_oracle(spark, duck, name):
    sdf = catalog.QUERIES[name](spark, SMALL)
    got = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    want = duck.execute(catalog.ORACLES[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_plan_has_ids_and_runs_on_whole_tables():
    catalog.load_all()
    assert len(catalog.QUERIES) >= 60
    for name, ids in catalog.IDS.items():
        assert ids.strip(), name
