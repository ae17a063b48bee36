"""Run registered plans on Spark and their oracle SQL on DuckDB; compare.

Usage: python scripts/parity.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from heliospark.plans import catalog  # noqa: E402
from heliospark.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def rows_of(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False):
        out.append(tuple(norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(a: pd.DataFrame, b: pd.DataFrame):
    ca, ra = rows_of(a)
    cb, rb = rows_of(b)
    if ca != cb:
        return f"columns differ: {ca} vs {cb}"
    if len(ra) != len(rb):
        return f"row count {len(ra)} vs {len(rb)}"
    exact = 0
    worst = 0.0
    bad = []
    for x, y in zip(ra, rb):
        if x == y:
            exact += 1
            continue
        for c, u, v in zip(ca, x, y):
            if u == v:
                continue
            if isinstance(u, (int, float)) and isinstance(v, (int, float)) and u is not None and v is not None:
                d = abs(u - v) / max(1.0, abs(u), abs(v))
                worst = max(worst, d)
                if d > 1e-9:
                    bad.append((c, u, v))
            else:
                bad.append((c, u, v))
    msg = f"rows={len(ra)} exact={exact} worst_rel={worst:.2e}"
    if bad:
        msg += f" MISMATCH {len(bad)} e.g. {bad[:3]}"
    return msg


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    catalog.load_all()
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name in names or list(catalog.QUERIES):
        t0 = time.time()
        try:
            sdf = catalog.QUERIES[name](spark, sf_dir)
            pdf = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        t1 = time.time()
        sql = catalog.ORACLES.get(name)
        if sql is None:
            print(f"{name:32s} spark rows={len(pdf)} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            odf = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SQL ERROR {str(e)[:400]}")
            continue
        print(f"{name:32s} {compare(pdf, odf)} spark={t1 - t0:.1f}s")


if __name__ == "__main__":
    main()
