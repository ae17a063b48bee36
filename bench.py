"""Benchmark the headline plans.

Runs each plan over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every plan is executed completely with the ``noop`` sink (no collect to the
driver); session start-up and a warm-up scan are excluded from the timings.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from heliospark.plans import catalog  # noqa: E402
from heliospark.session import build_session  # noqa: E402

# Headline plans; the boosted-tree plans (a fixed 200-iteration schedule) come last.
HEADLINE = [
    "daily_decision_summary",
    "hourly_grid",
    "psh_daily",
    "ghi_daily",
    "weekly_trend",
    "city_operating",
    "kpi_row",
    "thermal_inertia",
    "seasonal_curve",
    "seasonal_summary",
    "hour_pivot",
    "daylight_regression",
    "ghi_histogram",
    "gap_runs",
    "impute_tiers",
    "feature_matrix",
    "corr_matrix",
    "sequence_digest",
    "backtest_daily",
    "model_metrics",
    "residual_density",
    "promotion_gate",
    "chrono_split",
    "payload_explode",
    "upsert_merge",
    "contract_violations",
    "coverage",
    "backfill_chunks",
    "station_features",
    "stream_hourly_mean",
    "stream_upsert",
    "drift_psi",
    "gbt_train_score",
    "feature_importance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), extra={"spark.driver.memory": "16g"})
    catalog.load_all()
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_sec", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
