"""Full build over a panel of the reference's size, timed per table; prints one JSON line.

Every order of the given tables is repeated on 24 following days, which makes
3.6 million readings at sf0.1, about as many as the published fact holds.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from checks import adapters as A  # noqa: E402
from heatmart.operators.analytics import heat_days_by_year  # noqa: E402
from heatmart.plans import build, marts  # noqa: E402
from heatmart.session import session  # noqa: E402
from heatmart.sources import sinks  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("panel", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": str(2 * int(cpus)), "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="panel-")
    repeated = (A.raw_weather(spark, sf_dir)
                .withColumn("_day", F.explode(F.sequence(F.lit(0), F.lit(23))))
                .withColumn("time", F.expr("date_add(to_date(time), _day)").cast("timestamp"))
                .drop("_day"))
    repeated.repartition(2 * int(cpus)).write.parquet(f"{folder}/raw_weather")
    raw = build.Raw(spark.read.parquet(f"{folder}/raw_weather"), A.raw_communes(spark, sf_dir),
                    A.raw_heat_health(spark, sf_dir), A.raw_winter(spark, sf_dir))

    times: dict[str, float] = {}

    def timed(write):
        def run(df, path):
            start = time.perf_counter()
            write(df, path)
            times[path.rsplit("/", 1)[1]] = round(time.perf_counter() - start, 2)
        return run

    build.rebuild, build.rebuild_by_month = timed(sinks.rebuild), timed(sinks.rebuild_by_month)
    start = time.perf_counter()
    # keep() binds its default writer when build() runs, so the timed one is picked up
    stored = build.build(spark, raw, f"{folder}/tables")
    times["run"] = round(time.perf_counter() - start, 2)
    start = time.perf_counter()
    build.check(stored).collect()
    times["check"] = round(time.perf_counter() - start, 2)
    start = time.perf_counter()
    heat_days_by_year(marts.wide(stored["fct_daily"], stored["stg_communes"])).collect()
    times["heat_days_by_year"] = round(time.perf_counter() - start, 2)
    print(json.dumps({"metric": "panel_build", "value": times["run"], "unit": "sec",
                      "raw_rows": raw.weather.count(), "fact_rows": stored["fct_daily"].count(),
                      "stages": times}))


if __name__ == "__main__":
    main()
