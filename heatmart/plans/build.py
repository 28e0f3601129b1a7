"""Building every table from the raw ones, each written once and read back from files."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from heatmart.operators import gate, presence, states
from heatmart.operators.quality import DECLARED, run_checks
from heatmart.operators.scale import cut_lineage, released
from heatmart.plans import marts, staging
from heatmart.sources import changes, versions
from heatmart.sources.sinks import rebuild, rebuild_by_month, rebuild_from


# Folders of the checks answered while building, and of the rows that failed them, by model.
CHECKS, QUARANTINE = "checks", "quarantine"
# Folders of the monthly states and of the days' bitmaps, published version by version; and of the numbers of places.
STATES, PRESENCE, PLACES = "states", "presence", "places"
KEY = ["date", "code_insee"]


@dataclass
class Raw:
    weather: DataFrame
    communes: DataFrame
    heat_health: DataFrame
    winter: DataFrame


@released()
def build(spark: SparkSession, raw: Raw, root: str, checked: bool = False) -> dict[str, DataFrame]:
    """Full rebuild under ``root``; returns the stored tables by name.

    A stored table has a known size, so Catalyst decides itself whether to
    broadcast it, and a lost executor never leads back to the raw data. With
    ``checked`` the declared checks are answered while the tables are written
    (see answered()), and rows that fail are copied aside.
    """
    stored: dict[str, DataFrame] = {}
    answers: list[DataFrame] = []

    def keep(name: str, df: DataFrame, write=rebuild) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        if checked and name in DECLARED:
            answers.append(gate.write_checked(df, name, DECLARED[name], path,
                                              f"{root.rstrip('/')}/{QUARANTINE}/{name}", write, stored))
        else:
            write(df, path)
        stored[name] = spark.read.parquet(path)
        return stored[name]

    communes = keep("stg_communes", staging.stg_communes(raw.communes))
    dimension = keep("dim_commune", marts.dim_commune(communes))
    keep("dim_region", marts.dim_region(communes))
    keep("dim_date", marts.dim_date(raw.weather).sortWithinPartitions("date"))
    keep("stg_heat_health", staging.stg_heat_health(raw.heat_health))
    keep("stg_winter", staging.stg_winter(raw.winter))
    weather = keep("stg_weather", staging.stg_weather(raw.weather, dimension), rebuild_by_month)
    fact = keep("fct_daily", marts.fct_daily(weather), rebuild_by_month)
    at = root.rstrip("/")
    panel = marts.wide(fact, communes)
    versions.publish(states.states(panel), f"{at}/{STATES}")
    rebuild(presence.numbered_places(communes), f"{at}/{PLACES}")
    versions.publish(presence.presence(panel, spark.read.parquet(f"{at}/{PLACES}")), f"{at}/{PRESENCE}")
    if checked:
        rebuild(reduce(DataFrame.unionByName, answers).coalesce(1), f"{at}/{CHECKS}")
    return stored


def answered(spark: SparkSession, root: str) -> DataFrame:
    """What check() tells, as the last checked build found it, without reading its tables again."""
    return spark.read.parquet(f"{root.rstrip('/')}/{CHECKS}")


@released()
def update(spark: SparkSession, raw: Raw, root: str, since: date) -> dict[str, DataFrame]:
    """Incremental build under ``root``: readings are staged anew from the month of ``since`` on.

    The same tables as a full rebuild when readings were only added, none of
    them for an earlier month, and the commune list is that of the last build.
    Earlier months of the staged readings and of the fact are neither read nor
    written. The small health tables are rebuilt.
    """
    at = root.rstrip("/")
    stored = load(spark, at)
    first = since.replace(day=1)
    fresh = raw.weather.where(F.col("time") >= F.lit(first).cast("timestamp"))
    days = stored["dim_date"].where(F.col("date") < F.lit(first)).unionByName(marts.dim_date(fresh))
    rebuild(cut_lineage(days).sortWithinPartitions("date"), f"{at}/dim_date")
    rebuild(staging.stg_heat_health(raw.heat_health), f"{at}/stg_heat_health")
    rebuild(staging.stg_winter(raw.winter), f"{at}/stg_winter")
    rebuild_from(staging.stg_weather(fresh, stored["dim_commune"]), f"{at}/stg_weather", first)
    months = spark.read.parquet(f"{at}/stg_weather").where(F.col("date_month") >= F.lit(first))
    rebuild_from(marts.fct_daily(months), f"{at}/fct_daily", first)
    done = load(spark, at)
    panel = marts.wide(done["fct_daily"].where(F.col("date_month") >= F.lit(first)), done["stg_communes"])
    earlier = versions.read(spark, f"{at}/{STATES}").where(F.col("date_month") < F.lit(first))
    versions.publish(earlier.unionByName(states.states(panel)), f"{at}/{STATES}")
    days = presence.presence(panel, spark.read.parquet(f"{at}/{PLACES}"))
    versions.publish(versions.read(spark, f"{at}/{PRESENCE}").where(F.col("date") < F.lit(first)).unionByName(days), f"{at}/{PRESENCE}")
    return done


@released()
def merge(spark: SparkSession, weather: DataFrame, root: str) -> dict[str, DataFrame]:
    """Merge raw readings of any days, late and repeated ones included, into the tables under ``root``.

    The same tables and states as a full rebuild with these readings added, as
    long as the commune list is that of the last build. Each (day, commune)
    keeps the better of its stored and new reading. Of the large tables only
    the months of the readings are read, and only months in which something
    changes are written; the states get the changes alone. A merge that broke
    off is finished by the next one.
    """
    at = root.rstrip("/")
    communes = spark.read.parquet(f"{at}/stg_communes")
    known = spark.read.parquet(f"{at}/dim_date")
    # days of readings that match no commune count as well; first, so no broken merge can lose them
    fresh = cut_lineage(marts.dim_date(weather).join(known, "date", "left_anti"))
    if not fresh.isEmpty():
        rebuild(cut_lineage(known.unionByName(fresh)).sortWithinPartitions("date"), f"{at}/dim_date")

    def find() -> DataFrame:
        places = spark.read.parquet(f"{at}/dim_commune")
        staged = cut_lineage(changes.dated(staging.stg_weather(weather, places)))
        stored = changes.stored_months(spark, f"{at}/stg_weather", changes.touched_months(staged))
        measures = [c for c in staged.columns if c in staging.MEASURED]
        return changes.best_changes(staged, stored, KEY, staging.best_order([*measures, "numero_departement"]))

    def fact(rows: DataFrame) -> DataFrame:
        return marts.fct_daily(rows.drop("inserted_at"))

    def signed(rows: DataFrame) -> DataFrame:
        """Wide rows that come into the fact and that leave it."""
        parts = [fact(rows.where(F.col("sign") == s)).withColumn("sign", F.lit(s)) for s in (1, -1)]
        return marts.wide(parts[0].unionByName(parts[1]), communes)

    def counted(rows: DataFrame, tag: str) -> None:
        folder, last = versions.current(spark, f"{at}/{STATES}")
        if last != tag:
            panel = marts.wide(spark.read.parquet(f"{at}/fct_daily"), communes)
            versions.publish(states.merged(spark.read.parquet(folder), cut_lineage(states.deltas(signed(rows))),
                                           lambda groups: states.of_groups(panel, groups)), f"{at}/{STATES}", tag)

    def present(rows: DataFrame, tag: str) -> None:
        folder, last = versions.current(spark, f"{at}/{PRESENCE}")
        if last != tag:
            added = presence.presence(signed(rows), spark.read.parquet(f"{at}/{PLACES}"))
            versions.publish(presence.merged(spark.read.parquet(folder), added), f"{at}/{PRESENCE}", tag)

    changes.carry_out(spark, f"{at}/changes", find, [
        lambda rows, _: changes.put(rows, f"{at}/stg_weather", KEY),
        lambda rows, _: changes.put(fact(rows.where("sign = 1")).withColumn("sign", F.lit(1)), f"{at}/fct_daily", KEY),
        counted, present])
    return load(spark, at)


def monthly_states(spark: SparkSession, root: str) -> DataFrame:
    """The states that the last build, update or merge published, for the reports of operators.states."""
    return versions.read(spark, f"{root.rstrip('/')}/{STATES}")


def check(stored: dict[str, DataFrame], communes_over: int | None = None) -> DataFrame:
    """Declared checks of every built table: (model, column, check, violations, status).

    ``communes_over`` takes the place of the declared coverage of the fact.
    """
    declared = dict(DECLARED)
    if communes_over is not None:
        declared["fct_daily"] = replace(declared["fct_daily"], more_than={"code_insee": communes_over})
    found = [run_checks(name, df, declared[name], stored) for name, df in stored.items()
             if name in declared]
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def load(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables a build left under ``root``."""
    names = ["stg_communes", "dim_commune", "dim_region", "dim_date", "stg_heat_health",
             "stg_winter", "stg_weather", "fct_daily"]
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}


def daily_presence(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The days' bitmaps of the last build, update or merge, and the numbered places, for operators.presence."""
    at = root.rstrip("/")
    return versions.read(spark, f"{at}/{PRESENCE}"), spark.read.parquet(f"{at}/{PLACES}")
