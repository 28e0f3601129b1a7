"""Dimensions, the daily fact and the wide frame the analyses read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heatmart import schemas
from heatmart.functions.dates import is_weekend, month_label, month_start
from heatmart.functions.numeric import round_to
from heatmart.functions.text import region_key
from heatmart.plans.staging import stamped


def dim_commune(communes: DataFrame) -> DataFrame:
    return stamped(communes.select("code_insee", "ville", "numero_departement", "latitude",
                                   "longitude", "inserted_at"), "dbt_loaded_at")


def dim_region(communes: DataFrame) -> DataFrame:
    """Distinct region names with their key; spelling variants stay separate rows."""
    names = communes.select(F.col("region").alias("nom_region")).where("nom_region is not null")
    return stamped(names.distinct().withColumn("region_key", region_key(F.col("nom_region"))),
                   "inserted_at")


def dim_date(raw_weather: DataFrame) -> DataFrame:
    """One row per observed day; gaps stay gaps."""
    days = (raw_weather.where("time is not null")
            .select(F.to_date("time").alias("date")).distinct())
    day = F.col("date")
    return stamped(days.select(
        day, F.year(day).alias("annee"), F.month(day).alias("mois"),
        month_label(day).alias("nom_mois"), month_start(day).alias("debut_mois"),
        F.dayofweek(day).alias("jour_semaine"), is_weekend(day).alias("est_weekend"),
    ), "inserted_at")


def fct_daily(weather: DataFrame) -> DataFrame:
    """The daily fact: staged readings with measures rounded to two decimals."""
    measures = {*schemas.MEASURES.values(), *schemas.EXTRA_MEASURES.values()}
    first = ["date", "code_insee", "ville", "numero_departement", "latitude", "longitude",
             "code_meteo"]
    return stamped(weather.select(
        *first, *[round_to(F.col(c), 2).alias(c) for c in weather.columns if c in measures],
    ), "inserted_at", "updated_at")


def wide(fact: DataFrame, communes: DataFrame) -> DataFrame:
    """Fact with department and region names, under the names the analyses use.

    The commune side is a stored dimension: Catalyst broadcasts it by its file
    size and otherwise shuffles, so no hint is given.
    """
    names = communes.select("code_insee", "departement", "region")
    joined = fact.join(names, "code_insee")
    return joined.withColumnsRenamed(schemas.WIDE_NAMES)
