"""Schemas of the landed (raw) tables and payloads, and fixed column lists."""

from __future__ import annotations

from pyspark.sql import types as T

# The daily variables of the weather service, in request order.
DAILY_VARIABLES = [
    "weather_code",
    "temperature_2m_mean", "temperature_2m_min", "temperature_2m_max",
    "apparent_temperature_mean", "apparent_temperature_min", "apparent_temperature_max",
    "relative_humidity_2m_mean", "relative_humidity_2m_min", "relative_humidity_2m_max",
    "dew_point_2m_mean",
    "precipitation_sum", "rain_sum", "snowfall_sum", "precipitation_hours",
    "wind_speed_10m_mean", "wind_speed_10m_max", "wind_gusts_10m_max",
    "wind_direction_10m_dominant",
    "cloud_cover_mean", "pressure_msl_mean", "sunshine_duration",
    "shortwave_radiation_sum", "et0_fao_evapotranspiration", "vapour_pressure_deficit_max",
    "soil_moisture_0_to_7cm_mean", "soil_moisture_7_to_28cm_mean",
    "soil_moisture_28_to_100cm_mean", "soil_temperature_0_to_7cm_mean",
]

# Published French name of each measure kept by staging.
MEASURES = {
    "temperature_2m_mean": "temperature_moyenne",
    "temperature_2m_min": "temperature_min",
    "temperature_2m_max": "temperature_max",
    "apparent_temperature_max": "temperature_ressentie_max",
    "apparent_temperature_mean": "temperature_ressentie_moyenne",
    "relative_humidity_2m_mean": "humidite_moyenne",
    "precipitation_sum": "precipitations_totales",
    "wind_speed_10m_mean": "vitesse_vent_moyenne",
    "wind_gusts_10m_max": "rafales_max",
    "pressure_msl_mean": "pression_moyenne",
    "sunshine_duration": "ensoleillement_duree",
}

# Measures the analyses read although staging does not need them.
EXTRA_MEASURES = {
    "rain_sum": "pluie_totale",
    "wind_speed_10m_max": "vitesse_vent_maximale",
}

# Names under which the analyses read the daily fact.
WIDE_NAMES = {
    "temperature_min": "temperature_minimale",
    "temperature_max": "temperature_maximale",
    "ensoleillement_duree": "duree_ensoleillement",
}

# Columns stamped at load time; never part of a comparison.
AUDIT_COLUMNS = ("inserted_at", "updated_at", "loaded_at", "dbt_loaded_at")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


RAW_WEATHER = T.StructType(
    [T.StructField("time", T.TimestampType())]
    + _strings("nom_poi", "ville")
    + _doubles("latitude_poi", "longitude_poi")
    + _strings("numero_departement")
    + _doubles(*DAILY_VARIABLES)
    + _strings("row_hash")
    + [T.StructField("insere_a", T.TimestampType())]
)

RAW_COMMUNES = T.StructType(
    _strings("code INSEE", "Commune", "Departement", "Région", "Numero_Departement")
    + _doubles("Latitude", "Longitude")
    + _strings("Centroide", "Service")
)

RAW_HEAT_HEALTH = T.StructType(
    [T.StructField("annee", T.DateType())]
    + _strings("libgeo", "dep", "reg", "nom_region")
    + _doubles("nb_j_can")
)

RAW_WINTER = T.StructType(
    [T.StructField("date", T.DateType())]
    + _strings("reg", "nom_region", "sous_chapitre", "theme", "indicateur")
    + _doubles("valeur")
)


def payload_schema(variables: list[str] = DAILY_VARIABLES) -> T.StructType:
    """One location of a weather payload.

    Values are read as strings, so one bad element cannot null the whole
    record; they are cast one by one afterwards.
    """
    texts = T.ArrayType(T.StringType())
    daily = T.StructType([T.StructField(n, texts) for n in ["time", *variables]])
    return T.StructType([T.StructField("daily", daily)])


HEALTH_RECORD = T.StructType(
    _strings("dep", "libgeo", "reg", "reglib", "annee") + _doubles("nb_j_can"))

# Columns of the emissions log, in file order.
_EMISSION_TEXT = {
    "project_name", "run_id", "experiment_id", "country_name", "country_iso_code", "region",
    "cloud_provider", "cloud_region", "os", "python_version", "codecarbon_version",
    "cpu_model", "gpu_model", "tracking_mode", "on_cloud",
}
_EMISSION_COLUMNS = (
    "timestamp project_name run_id experiment_id duration emissions emissions_rate cpu_power "
    "gpu_power ram_power cpu_energy gpu_energy ram_energy energy_consumed water_consumed "
    "country_name country_iso_code region cloud_provider cloud_region os python_version "
    "codecarbon_version cpu_count cpu_model gpu_count gpu_model longitude latitude "
    "ram_total_size tracking_mode cpu_utilization_percent gpu_utilization_percent "
    "ram_utilization_percent ram_used_gb on_cloud pue wue"
).split()
EMISSIONS_LOG = T.StructType([
    T.StructField(n, T.TimestampType() if n == "timestamp"
                  else T.StringType() if n in _EMISSION_TEXT else T.DoubleType())
    for n in _EMISSION_COLUMNS
])

STEP_METRICS = T.MapType(T.StringType(), T.StructType(
    _strings("step") + _doubles("emissions_kg_co2", "duration_seconds") + _strings("status")))
