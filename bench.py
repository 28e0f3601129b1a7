"""Headline queries, timed one by one; prints one JSON line.

Each query runs to a sink that discards its rows, after one warm-up query that
starts the engine. BENCH_SF_DIR names the tables, BENCH_CPUS the threads, and
BENCH_QUERIES (comma-separated) narrows the list.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.catalog import QUERIES  # noqa: E402
from heatmart.session import session  # noqa: E402

HEADLINE = [
    "m_stg_communes", "j1_place_resolution", "m_stg_weather", "m_fct_daily", "m_wide",
    "a16_heat_days_year", "m_dim_date", "m_stg_winter", "m_stg_heat_health", "m_dim_region",
    "s5_daily_arrays", "j6_append_new_keys", "j7_append_new_hash", "j9_record_hash_dedup",
    "w2_weather_dedup", "w4_heatwave_3day", "a1_coverage", "a2_null_profile", "a5_coherence",
    "a8_incomplete_days", "a10_insert_trace", "a13_yearly_trend", "a14_department_climate",
    "a20_weather_health", "a21_corr_matrix", "a23_describe", "a24_histogram",
    "a33_period_region", "f1_fold_name", "q_declared_checks", "t2_stream_append",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("a17_heat_days_month")
    times = {name: run(name) for name in names}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
