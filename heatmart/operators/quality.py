"""Data-quality profiles and declared checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from heatmart.functions.numeric import round_to
from heatmart.operators.shape import to_rows

# Columns whose missing values are profiled.
PROFILED = ["date", "ville", "code_insee", "departement", "region", "temperature_moyenne",
            "humidite_moyenne", "vitesse_vent_moyenne", "pression_moyenne"]
PROFILED_RAW = ["nom_poi", "latitude_poi", "temperature_2m_mean"]
# Markers of a missing measure.
SENTINELS = (-999.0, -9999.0)


def coverage(panel: DataFrame) -> DataFrame:
    """Size and extent of the panel in one row."""
    day = F.to_date("date")
    return panel.agg(
        F.count("*").alias("total_lignes"),
        F.countDistinct("ville").alias("nb_communes"),
        F.countDistinct("code_insee").alias("nb_codes_insee"),
        F.countDistinct("departement").alias("nb_departements"),
        F.countDistinct("region").alias("nb_regions"),
        F.min(day).alias("date_min"), F.max(day).alias("date_max"),
        F.countDistinct(day).alias("nb_jours"))


def null_profile(df: DataFrame, columns: list[str] = PROFILED) -> DataFrame:
    """Missing values per column with their share in percent."""
    counted = df.agg(F.count("*").alias("_total"),
                     *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return to_rows(counted, "colonne", {
        c: {"nb_nulls": F.col(c),
            "taux": round_to(F.try_divide(F.col(c) * 100.0, F.col("_total")), 3)}
        for c in columns})


def bounds(panel: DataFrame) -> DataFrame:
    """Extreme values of the measures, one decimal."""
    ends = {
        "temp_min_absolue": F.min("temperature_minimale"),
        "temp_max_absolue": F.max("temperature_maximale"),
        "humidite_min": F.min("humidite_moyenne"), "humidite_max": F.max("humidite_moyenne"),
        "precip_min": F.min("precipitations_totales"),
        "precip_max": F.max("precipitations_totales"),
        "vent_max": F.max("vitesse_vent_maximale"),
        "pression_min": F.min("pression_moyenne"), "pression_max": F.max("pression_moyenne"),
    }
    return panel.agg(*[round_to(c, 1).alias(n) for n, c in ends.items()])


def coherence(panel: DataFrame) -> DataFrame:
    """Rows whose measures contradict each other, per rule."""
    low, mean, high = (F.col(f"temperature_{c}") for c in ("minimale", "moyenne", "maximale"))
    humidity, rain = F.col("humidite_moyenne"), F.col("precipitations_totales")
    rules = {
        "min_superieur_max": low > high,
        "moyenne_sous_min": mean < low,
        "moyenne_sur_max": mean > high,
        "humidite_hors_bornes": ~humidity.between(0, 100),
        "precipitations_negatives": rain < 0,
    }
    if "pluie_totale" in panel.columns:
        rules["pluie_superieure_precip"] = F.col("pluie_totale") > rain
    counted = panel.agg(*[F.count_if(rule).alias(n) for n, rule in rules.items()])
    return to_rows(counted, "regle", {
        n: {"nb_anomalies": F.col(n),
            "statut": F.when(F.col(n) == 0, "OK").otherwise("A CORRIGER")} for n in rules})


def key_uniqueness(panel: DataFrame, keys: tuple[str, str] = ("date", "ville")) -> DataFrame:
    """Rows against distinct complete keys."""
    return panel.agg(
        F.count("*").alias("total_lignes"), F.countDistinct(*keys).alias("couples_uniques"),
    ).withColumn("doublons", F.col("total_lignes") - F.col("couples_uniques"))


def continuity(panel: DataFrame) -> DataFrame:
    """Days present against days between first and last."""
    day = F.to_date("date")
    return panel.agg(
        F.min(day).alias("date_min"), F.max(day).alias("date_max"),
        F.countDistinct(day).alias("jours_presents"),
    ).withColumn("jours_attendus", F.datediff("date_max", "date_min") + 1
                 ).withColumn("jours_manquants", F.col("jours_attendus") - F.col("jours_presents"))


def incomplete_days(panel: DataFrame, expected: int = 360) -> DataFrame:
    """Days on which fewer towns than expected report."""
    return (panel.groupBy(F.to_date("date").alias("jour"))
            .agg(F.countDistinct("ville").alias("nb_communes"))
            .where(F.col("nb_communes") < expected).orderBy("jour"))


def name_variants(df: DataFrame, code: str = "code_insee", name: str = "ville") -> DataFrame:
    """Codes written in more than one way. Spellings are made distinct before they meet."""
    spellings = df.where(F.col(name).isNotNull()).select(code, name).distinct()
    return (spellings.groupBy(code)
            .agg(F.count("*").alias("nb_variantes"),
                 F.expr(f"listagg({name}, ' | ') within group (order by {name})")
                 .alias("orthographes"))
            .where("nb_variantes > 1"))


def day_coverage(panel: DataFrame, as_of, lag: int = 5) -> DataFrame:
    """Communes present on the day that should have just arrived."""
    day = F.date_sub(F.lit(as_of), lag)
    return panel.where(F.to_date("date") == day).agg(
        F.countDistinct("code_insee").alias("communes"))


def fact_size(panel: DataFrame) -> DataFrame:
    return panel.agg(F.count("*").alias("lignes"),
                     F.countDistinct(F.to_date("date")).alias("jours"))


# ---- declared checks -------------------------------------------------------


@dataclass
class Checks:
    """What a model promises.

    Keys of ``unique`` are tuples of columns; ``references`` names a column's parent model.
    """

    not_null: list[str] = field(default_factory=list)
    unique: list[tuple[str, ...]] = field(default_factory=list)
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    no_sentinel: list[str] = field(default_factory=list)
    more_than: dict[str, int] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)


# Accepted ranges of the measures.
RANGES = {"temperature_moyenne": (-30.0, 45.0), "humidite_moyenne": (0.0, 100.0),
          "precipitations_totales": (0.0, None)}

# The promises of the published models.
DECLARED = {
    "stg_communes": Checks(not_null=["code_insee", "ville", "latitude", "longitude"],
                           unique=[("code_insee",)]),
    "stg_weather": Checks(not_null=["code_insee", "date", "temperature_moyenne", "ville"]),
    "dim_commune": Checks(not_null=["code_insee", "ville"], unique=[("code_insee",)]),
    "dim_date": Checks(not_null=["date", "annee", "mois"], unique=[("date",)]),
    "fct_daily": Checks(not_null=["code_insee", "date"], unique=[("date", "code_insee")],
                        ranges=RANGES, no_sentinel=list(RANGES), more_than={"code_insee": 350},
                        references={"code_insee": "dim_commune"}),
    "stg_heat_health": Checks(not_null=["annee"]),
}


def out_of_range(column: str, low: float | None, high: float | None) -> Column:
    value = F.col(column)
    wrong = F.lit(False)
    if low is not None:
        wrong = wrong | (value < low)
    if high is not None:
        wrong = wrong | (value > high)
    return wrong


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows lacking any of the columns."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return df.where(missing)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Complete keys held by more than one row."""
    return df.na.drop(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def rows_out_of_range(df: DataFrame, column: str, low: float | None = None,
                      high: float | None = None) -> DataFrame:
    return df.where(out_of_range(column, low, high))


def orphans(df: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Values without a row in the parent table, with the number of rows bearing them."""
    used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return used.join(parent.select(column).distinct(), column, "left_anti")


def too_few(column: str, more_than: int) -> Column:
    """Aggregate: whether the column lacks more than that many distinct values."""
    return F.countDistinct(column) <= more_than


def low_coverage(df: DataFrame, column: str, more_than: int) -> DataFrame:
    """One row when the column holds too few distinct values, none otherwise."""
    return (df.agg(F.countDistinct(column).alias("n"), too_few(column, more_than).alias("few"))
            .where("few").select("n"))


def sentinels(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column that hold a marker instead of a measure."""
    counted = df.agg(*[F.count_if(F.col(c).isin(*SENTINELS)).alias(c) for c in columns])
    return to_rows(counted, "colonne", {c: {"nb_sentinelles": F.col(c)} for c in columns})


def run_checks(model: str, df: DataFrame, checks: Checks,
               models: dict[str, DataFrame] | None = None) -> DataFrame:
    """All checks of a model: (model, column, check, violations, status).

    Everything but uniqueness and references comes from a single aggregate over
    the table. ``models`` holds the parents of references.
    """
    counts: dict[tuple[str, str], Column] = {}
    for c in checks.not_null:
        counts[c, "not_null"] = F.count_if(F.col(c).isNull())
    for c, (low, high) in checks.ranges.items():
        counts[c, "range"] = F.count_if(out_of_range(c, low, high))
    for c in checks.no_sentinel:
        counts[c, "sentinel"] = F.count_if(F.col(c).isin(*SENTINELS))
    for c, least in checks.more_than.items():
        counts[c, "coverage"] = F.when(too_few(c, least), 1).otherwise(0).cast("bigint")
    parts = []
    if counts:
        row = df.agg(*[v.alias(f"{c}|{k}") for (c, k), v in counts.items()])
        entries = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"),
                                     F.col(f"`{c}|{k}`").alias("violations"))
                            for c, k in counts])
        parts.append(row.select(F.inline(entries)))
    for keys in checks.unique:
        parts.append(repeated_keys(df, list(keys)).agg(F.count("*").alias("violations"))
                     .select(F.lit(", ".join(keys)).alias("column"),
                             F.lit("unique").alias("check"), "violations"))
    for c, parent in checks.references.items():
        parts.append(orphans(df, models[parent], c)
                     .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
                     .select(F.lit(c).alias("column"), F.lit("relationship").alias("check"),
                             "violations"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(
        F.lit(model).alias("model"), "column", "check", "violations",
        F.when(F.col("violations") == 0, "pass").otherwise("fail").alias("status"))
