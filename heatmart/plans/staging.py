"""Staging models: cleaned, resolved and deduplicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heatmart import schemas
from heatmart.functions.text import staging_code
from heatmart.operators.dedup import best_order, best_reading, one_per_commune
from heatmart.operators.resolve import resolve_best
from heatmart.operators.scale import BROADCAST_BYTES
from heatmart.sources import raw as scan


# Measures of a staged reading, all that may be there.
MEASURED = ["code_meteo", *schemas.MEASURES.values(), *schemas.EXTRA_MEASURES.values()]


def stamped(df: DataFrame, *columns: str) -> DataFrame:
    """Add load-time columns; current_timestamp() is one value per query."""
    return df.withColumns({c: F.current_timestamp() for c in columns})


def stg_communes(raw: DataFrame) -> DataFrame:
    """The commune list, one row per official code."""
    listed = scan.communes(raw)
    listed = scan.present(listed, ["code", "ville", "latitude", "longitude"]).where("ville != ''")
    coded = listed.select(staging_code(F.col("code")).alias("code_insee"), *listed.columns[1:])
    return stamped(one_per_commune(coded), "inserted_at", "dbt_loaded_at")


def _renamed(readings: DataFrame) -> tuple[DataFrame, list[str]]:
    """Readings under French names, with the measures that are there."""
    extra = {k: v for k, v in schemas.EXTRA_MEASURES.items() if k in readings.columns}
    names = {"weather_code": "code_meteo", **schemas.MEASURES, **extra}
    renamed = readings.select(
        F.to_date("time").alias("date"), "nom_poi", "ville",
        *[F.col(k).alias(v) for k, v in names.items()])
    return renamed, list(names.values())


def stg_weather(raw: DataFrame, communes: DataFrame,
                limit: int = BROADCAST_BYTES) -> DataFrame:
    """Readings resolved to communes, one per (day, commune).

    Measures come first among the tie breaks, so the best reading of a place is
    the best one in each of its communes. Name and coordinates follow from the
    code; only the department can still differ.
    """
    readings, measures = _renamed(scan.weather(raw))

    def choose(df: DataFrame, keys: list[str]) -> DataFrame:
        return best_reading(df, keys, measures)

    found = resolve_best(readings, communes, choose, limit)
    kept = best_reading(found, ["date", "code_insee"], measures + ["numero_departement"])
    ordered = ["date", "code_insee", "ville", *measures, "numero_departement",
               "latitude", "longitude"]
    return stamped(kept.select(*ordered), "inserted_at")


def stg_heat_health(raw: DataFrame) -> DataFrame:
    return stamped(scan.heat_health(raw), "loaded_at")


def stg_winter(raw: DataFrame) -> DataFrame:
    return stamped(scan.winter(raw), "loaded_at")
