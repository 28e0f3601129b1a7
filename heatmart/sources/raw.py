"""Scans of the raw tables and of the location lists made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from heatmart.functions.text import collector_code, pad_department, region_key, trim_space
from heatmart.operators.dedup import ascending, first_per_key
from heatmart.operators.scale import cut_lineage, spread_nulls

CODE = "`code INSEE`"


def weather(raw: DataFrame) -> DataFrame:
    """Readings that carry a day."""
    return raw.where("time is not null")


def communes(raw: DataFrame) -> DataFrame:
    """The commune list under names without spaces or accents; texts trimmed."""
    trimmed = {"Commune": "ville", "Departement": "departement", "Région": "region"}
    return raw.select(
        F.col(CODE).cast("string").alias("code"),
        *[trim_space(F.col(f"`{c}`")).alias(n) for c, n in trimmed.items()],
        F.col("Numero_Departement").cast("string").alias("numero_departement"),
        F.col("Latitude").cast("double").alias("latitude"),
        F.col("Longitude").cast("double").alias("longitude"),
        trim_space(F.col("Centroide")).alias("centroide"),
        trim_space(F.col("Service")).alias("service"))


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where all the columns are present."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def not_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is more than white space."""
    return df.where(trim_space(F.col(column)) != "")


def heat_health(raw: DataFrame) -> DataFrame:
    """Heat-wave days per department and year; incomplete records drop out."""
    return present(raw, ["annee", "libgeo", "nb_j_can"]).select(
        "annee", F.col("libgeo").alias("departement_nom"), F.col("dep").alias("departement_code"),
        "reg", "nom_region", region_key(F.col("nom_region")).alias("region_key"),
        F.col("nb_j_can").alias("nb_jours_canicule"))


def winter(raw: DataFrame) -> DataFrame:
    """Winter-epidemic indicators that are dated and valued.

    A region's key is worked out once per name, not per row: the names are
    written down first, so Catalyst knows their size.
    """
    rows = present(raw, ["date", "valeur"])
    names = rows.select(F.col("nom_region").alias("_name")).where("_name is not null").distinct()
    keys = cut_lineage(names.withColumn("region_key", region_key(F.col("_name"))))
    name = spread_nulls(F.col("nom_region"), F.col("date"), F.col("reg"), F.col("valeur"))
    return rows.join(keys, name == F.col("_name"), "left").select(
        "date", "reg", "nom_region", "region_key", "sous_chapitre", "theme", "indicateur", "valeur")


def locations(raw: DataFrame) -> DataFrame:
    """Locations the daily collection asks for, one per official code."""
    found = raw.select(
        collector_code(F.col(CODE)).alias("code_insee"), F.col("Commune").alias("ville"),
        F.col("Numero_Departement").alias("numero_departement"),
        F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"))
    found = present(found, ["code_insee", "latitude", "longitude"])
    rest = ["ville", "numero_departement", "latitude", "longitude"]
    return first_per_key(found, ["code_insee"], ascending(rest))


def backfill_locations(raw: DataFrame) -> DataFrame:
    """Locations the history load asks for: distinct name and coordinates, by name."""
    return (present(raw, ["Commune", "Latitude", "Longitude"])
            .select("Commune", "Latitude", "Longitude", "Numero_Departement").distinct()
            .select(F.col("Commune").alias("name"), F.col("Latitude").alias("lat"),
                    F.col("Longitude").alias("lon"),
                    pad_department(F.col("Numero_Departement")).alias("dept"))
            .orderBy("name", "lat", "lon", "dept"))
