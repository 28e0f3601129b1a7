"""Command line, for spark-submit: build the tables, check them, ingest, print a report.

  job.py ingest  --payloads DIR --locations DIR --raw-weather DIR --as-of 2026-09-01
  job.py history --payloads DIR --locations DIR --raw-weather DIR --first DAY --last DAY
  job.py build   --weather DIR --communes DIR --heat DIR --winter DIR --root DIR
                 [--since 2026-07-01 | --checked]
  job.py merge   --weather DIR --root DIR
  job.py check   --root DIR [--communes-over 350]
  job.py report  --root DIR --name heat_days_by_year [--out DIR] [--rows 100]
                 [--since 2015-01-01] [--from-year 2015] [--to-year 2025] [--states]

build --since stages only the months from that day on; --checked answers the checks while the tables are written; merge takes readings of any days, late and repeated ones
included. report --states reads the monthly states or the days' bitmaps instead of the fact, where the report has such a
form. Without --out a report prints its first rows and how many there are. Years and
days are unbounded unless given.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from heatmart import schemas
from heatmart.functions.dates import between_days
from heatmart.operators import analytics, health, presence, quality, states, stats
from heatmart.operators.scale import cut_lineage, released
from heatmart.plans import build, ingest, marts
from heatmart.session import measured, session, sized_for

Tables = dict[str, DataFrame]
# Options that name folders to read.
INPUTS = ["payloads", "locations", "raw_weather", "weather", "communes", "heat", "winter", "root"]


def panel(tables: Tables, since: date | None = None) -> DataFrame:
    """The wide daily frame; ``since`` also prunes the fact's months."""
    fact = between_days(tables["fct_daily"], since)
    return marts.wide(fact, tables["stg_communes"])


REPORTS: dict[str, Callable[[Tables, argparse.Namespace], DataFrame]] = {
    "coverage": lambda t, o: quality.coverage(panel(t)),
    "nulls": lambda t, o: quality.null_profile(panel(t)),
    "bounds": lambda t, o: quality.bounds(panel(t)),
    "coherence": lambda t, o: quality.coherence(panel(t)),
    "key_uniqueness": lambda t, o: quality.key_uniqueness(panel(t)),
    "continuity": lambda t, o: quality.continuity(panel(t)),
    "incomplete_days": lambda t, o: quality.incomplete_days(panel(t)),
    "name_variants": lambda t, o: quality.name_variants(panel(t)),
    "run_history": lambda t, o: analytics.run_history(t["fct_daily"]),
    "department_years": lambda t, o: analytics.department_years(t["stg_heat_health"]),
    "summary": lambda t, o: stats.summary(panel(t, o.since)),
    "histograms": lambda t, o: stats.histograms(panel(t, o.since)),
    "correlations": lambda t, o: stats.correlation_matrix(panel(t, o.since)),
    "seasonality": lambda t, o: analytics.seasonality(panel(t, o.since)),
    "yearly_trend": lambda t, o: analytics.yearly_trend(panel(t)),
    "linear_trend": lambda t, o: analytics.linear_trend(analytics.yearly_trend(panel(t)), o.to_year + 1),
    "departments": lambda t, o: analytics.department_climate(panel(t), o.from_year, o.to_year),
    "regions": lambda t, o: analytics.region_climate(
        analytics.department_climate(panel(t), o.from_year, o.to_year)),
    "warmest_and_coolest": lambda t, o: analytics.warmest_and_coolest(
        analytics.department_climate(panel(t), o.from_year, o.to_year)),
    "heat_days_by_year": lambda t, o: analytics.heat_days_by_year(panel(t)),
    "heat_days_by_month": lambda t, o: analytics.heat_days_by_month(panel(t)),
    "weather_health": lambda t, o: health.weather_health(panel(t), t["stg_heat_health"]),
    "health_correlations": lambda t, o: health.health_correlations(
        health.weather_health(panel(t), t["stg_heat_health"])),
    "key_coverage": lambda t, o: health.key_coverage(
        t["stg_communes"], t["stg_heat_health"], "departement", "departement_nom"),
    "key_gaps": lambda t, o: health.key_gaps(
        t["stg_communes"], t["stg_heat_health"], "departement", "departement_nom"),
}

# Reports that the monthly states answer, and those that the days' bitmaps do.
STATE_REPORTS: dict[str, Callable[[DataFrame, argparse.Namespace], DataFrame]] = {
    "seasonality": lambda t, o: states.seasonality(t),
    "yearly_trend": lambda t, o: states.yearly_trend(t),
    "linear_trend": lambda t, o: analytics.linear_trend(states.yearly_trend(t), o.to_year + 1),
    "heat_days_by_year": lambda t, o: states.heat_days_by_year(t),
    "heat_days_by_month": lambda t, o: states.heat_days_by_month(t),
}
PRESENCE_REPORTS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "coverage": presence.coverage,
    "key_uniqueness": lambda d, _: presence.key_uniqueness(d),
    "incomplete_days": lambda d, _: presence.incomplete_days(d),
    "continuity": lambda d, _: presence.continuity(d),
}


@released()
def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one command; 0 when it succeeded."""
    if args.command in ("ingest", "history"):
        landed = spark.read.schema("batch_id long, body string").json(args.payloads)
        places = spark.read.parquet(args.locations)
        if args.command == "ingest":
            done = ingest.daily_weather(landed, places, args.raw_weather,
                                        date.fromisoformat(args.as_of))
        else:
            done = ingest.history_weather(landed, places, args.raw_weather,
                                          date.fromisoformat(args.first),
                                          date.fromisoformat(args.last))
        print(f"received {done.received}, inserted {done.inserted}, skipped {done.skipped}, "
              f"unreadable {done.unreadable}, without location {done.unmatched}, {done.verdict}")
        return int(done.verdict == "refused")
    if args.command == "build":
        read = {"weather": schemas.RAW_WEATHER, "communes": schemas.RAW_COMMUNES,
                "heat": schemas.RAW_HEAT_HEALTH, "winter": schemas.RAW_WINTER}
        raw = [spark.read.schema(s).parquet(getattr(args, n)) for n, s in read.items()]
        if args.since:
            build.update(spark, build.Raw(*raw), args.root, args.since)
        else:
            build.build(spark, build.Raw(*raw), args.root, args.checked)
        return tell(build.answered(spark, args.root)) if args.checked else 0
    if args.command == "merge":
        build.merge(spark, spark.read.schema(schemas.RAW_WEATHER).parquet(args.weather), args.root)
        return 0
    tables = build.load(spark, args.root)
    if args.command == "check":
        return tell(build.check(tables, args.communes_over))
    if args.states and args.name in PRESENCE_REPORTS:
        result = PRESENCE_REPORTS[args.name](*build.daily_presence(spark, args.root))
    elif args.states:
        result = STATE_REPORTS[args.name](build.monthly_states(spark, args.root), args)
    else:
        result = REPORTS[args.name](tables, args)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    else:
        result = cut_lineage(result)
        total = result.count()
        result.show(args.rows, truncate=False)
        print(f"first {min(args.rows, total)} of {total} rows")
    return 0


def tell(answers) -> int:
    """Print the answers of checks, some dozens; 1 if any failed."""
    found = answers.collect()
    for r in found:
        print(f"{r.status} {r.model}.{r.column} {r.check}: {r.violations}")
    return int(any(r.status == "fail" for r in found))


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="heatmart.job")
    commands = parser.add_subparsers(dest="command", required=True)
    options = {"ingest": ["payloads", "locations", "raw-weather", "as-of"],
               "history": ["payloads", "locations", "raw-weather", "first", "last"],
               "build": ["weather", "communes", "heat", "winter", "root"],
               "merge": ["weather", "root"], "check": ["root"], "report": ["root"]}
    for name, wanted in options.items():
        command = commands.add_parser(name)
        for option in wanted:
            command.add_argument(f"--{option}", required=True)
    commands.choices["report"].add_argument("--name", choices=sorted(REPORTS), required=True)
    report = commands.choices["report"]
    report.add_argument("--out")
    report.add_argument("--rows", type=int, default=100, help="rows to print without --out")
    for name in ("build", "report"):
        commands.choices[name].add_argument("--since", type=date.fromisoformat)
    commands.choices["build"].add_argument("--checked", action="store_true")
    commands.choices["check"].add_argument("--communes-over", type=int, default=350)
    report.add_argument("--states", action="store_true")
    report.add_argument("--from-year", type=int, default=1)
    report.add_argument("--to-year", type=int, default=9998)
    for command in commands.choices.values():
        command.add_argument("--input-gb", type=int, default=0,
                             help="size of the input, if it should not be measured")
    chosen = parser.parse_args(argv)
    if getattr(chosen, "checked", False) and chosen.since:
        parser.error("--checked goes with a full build; check reads the tables of any")
    if getattr(chosen, "states", False) and (
            chosen.name not in {**STATE_REPORTS, **PRESENCE_REPORTS} or chosen.since):
        parser.error("--states answers " + ", ".join(sorted({**STATE_REPORTS, **PRESENCE_REPORTS})) + ", over all days")
    return chosen


if __name__ == "__main__":
    options = parse()
    spark = session()
    paths = [getattr(options, n) for n in INPUTS if getattr(options, n, None)]
    for key, value in sized_for(options.input_gb * 1024 ** 3 or measured(spark, paths)).items():
        spark.conf.set(key, value)
    raise SystemExit(run(spark, options))
