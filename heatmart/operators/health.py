"""Weather crossed with health indicators at department-year grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heatmart.functions.numeric import pearson, round_to
from heatmart.functions.text import fold_name, pad_department
from heatmart.operators.dedup import best_reading
from heatmart.operators.scale import spread_nulls


def _annual() -> dict:
    hot = F.col("temperature_maximale")
    return {
        "temp_moyenne_annuelle": round_to(F.avg("temperature_moyenne"), 2),
        "temp_max_absolue": round_to(F.max(hot), 1),
        "jours_sup_35": F.count_if(hot > 35),
        "jours_sup_30": F.count_if(hot > 30),
        "humidite_moyenne": round_to(F.avg("humidite_moyenne"), 1),
        "precipitations_annuelles": round_to(F.sum("precipitations_totales"), 1),
    }


def _in_summer():
    return F.month("date").between(6, 9)


def _summer() -> dict:
    """Means over June to September, as conditional aggregates."""
    def mean(column: str):
        return round_to(F.avg(F.when(_in_summer(), F.col(column))), 2)

    return {"temp_moyenne_ete": mean("temperature_moyenne"),
            "temp_max_moyenne_ete": mean("temperature_maximale")}


def _grouped(panel: DataFrame, measures: dict) -> DataFrame:
    return (panel.groupBy(F.year("date").alias("annee"), "departement")
            .agg(*[c.alias(n) for n, c in measures.items()]))


def department_year(panel: DataFrame) -> DataFrame:
    return _grouped(panel, _annual())


def department_summer(panel: DataFrame) -> DataFrame:
    return _grouped(panel.where(_in_summer()), _summer())


def annual_with_summer(annual: DataFrame, summer: DataFrame) -> DataFrame:
    return annual.join(summer, ["annee", "departement"])


def with_health(weather: DataFrame, health: DataFrame) -> DataFrame:
    """Department-years present on both sides; departments meet by name."""
    recorded = health.select(F.year("annee").alias("annee"),
                             F.col("departement_nom").alias("departement"), "nb_jours_canicule")
    return weather.join(recorded, ["annee", "departement"])


def weather_health(panel: DataFrame, health: DataFrame) -> DataFrame:
    """Annual and summer weather with heat-wave days, latest year first.

    Both weather sides come from one pass; a department-year without any
    summer day is left out, as joining the two sides would.
    """
    both = _grouped(panel, {**_annual(), **_summer(), "_summer": F.count_if(_in_summer())})
    weather = both.where("_summer > 0 and departement is not null").drop("_summer")
    return with_health(weather, health).select(
        "annee", "departement", "temp_moyenne_annuelle", "temp_moyenne_ete",
        "temp_max_moyenne_ete", "temp_max_absolue", "jours_sup_30", "jours_sup_35",
        "humidite_moyenne", "precipitations_annuelles", "nb_jours_canicule",
    ).orderBy(F.desc("annee"), "departement")


def reading_departments(readings: DataFrame, communes: DataFrame, health: DataFrame) -> DataFrame:
    """(numero_departement, ville, departement_code) of each distinct pair on readings.

    The department's code decides if the health table has it. Otherwise, and
    only then, the folded town name is looked up among the communes, and
    those of its departments that the health table has are taken: none,
    one, or, for a name several communes bear, more.
    """
    known = health.select(pad_department(F.col("departement_code")).alias("departement_code")).where(
        "departement_code is not null").distinct()
    named = communes.select(fold_name(F.col("ville")).alias("name_key"),
                            pad_department(F.col("numero_departement")).alias("departement_code")).distinct()
    named = named.join(known, "departement_code").where("name_key <> ''")
    pairs = readings.select("numero_departement", "ville").distinct()
    by = ["numero_departement", "ville"]
    own = spread_nulls(pad_department(F.col("numero_departement")), F.col("ville"))
    first = pairs.join(known, own == F.col("departement_code"), "left")
    name = spread_nulls(F.when(F.col("departement_code").isNull(), fold_name(F.col("ville"))), *by)
    second = first.select(*by, F.col("departement_code").alias("own_code"), name.alias("key")).join(named, F.col("key") == F.col("name_key"), "left")
    return second.select(*by, F.coalesce("own_code", "departement_code").alias("departement_code"))


def enriched(readings: DataFrame, communes: DataFrame, health: DataFrame, ties: list[str]) -> DataFrame:
    """Readings with department code and heat-wave days of their year, one per (date, code_insee).

    Departments are found for distinct (department, town) pairs, not for
    readings, see reading_departments(). A reading whose department is not
    found, or has no record of the year, stays without. Of what a shared name
    multiplied, and of repeated readings, the best one is kept, the smallest
    department code last among the ties.
    """
    found = reading_departments(readings, communes, health).select(
        F.col("numero_departement").alias("_number"), F.col("ville").alias("_town"), "departement_code")
    same = F.col("numero_departement").eqNullSafe(F.col("_number")) & F.col("ville").eqNullSafe(F.col("_town"))
    placed = readings.join(found, same).drop("_number", "_town").withColumn("annee", F.year("date"))
    recorded = health.select(F.year("annee").alias("annee"), pad_department(F.col("departement_code")).alias("departement_code"),
                             "nb_jours_canicule")
    both = placed.join(recorded, ["departement_code", "annee"], "left").drop("annee")
    return best_reading(both, ["date", "code_insee"], [*ties, "departement_code", "nb_jours_canicule"])


def health_correlations(crossed: DataFrame) -> DataFrame:
    """Correlation of summer heat and of hot days with recorded heat-wave days."""
    days = F.col("nb_jours_canicule").cast("double")
    return crossed.agg(
        pearson(F.col("temp_max_moyenne_ete"), days).alias("r_temp_ete"),
        pearson(F.col("jours_sup_35").cast("double"), days).alias("r_jours_35"))


def _both_sides(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full join of the distinct keys: (ours, theirs) with marks for presence per side."""
    ours = left.select(F.col(left_key).alias("ours")).distinct().withColumn("in_left", F.lit(1))
    theirs = (right.select(F.col(right_key).alias("theirs")).distinct()
              .withColumn("in_right", F.lit(1)))
    return ours.join(theirs, F.col("ours") == F.col("theirs"), "full")


def key_coverage(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct keys on each side and how many meet, in one row."""
    return _both_sides(left, right, left_key, right_key).agg(
        F.count("in_left").alias("nb_gauche"), F.count("in_right").alias("nb_droite"),
        F.count(F.col("in_left") + F.col("in_right")).alias("nb_correspondances"))


# what a key list means to NOT IN
EMPTY, COMPLETE, WITH_NULL = 0, 1, 2


def _kind(df: DataFrame, key: str) -> Column:
    rows, nulls = F.count("*"), F.count_if(F.col(key).isNull())
    return df.agg(F.when(rows == 0, EMPTY).when(nulls > 0, WITH_NULL).otherwise(COMPLETE)
                  .alias("kind")).scalar()


def key_gaps(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
             labels: tuple[str, str] = ("meteo seulement", "odisse seulement")) -> DataFrame:
    """Keys found on one side only, labelled by side, as NOT IN finds them.

    NOT IN would broadcast each whole list to stay NULL-aware. One full join
    and the kind of each list give the same rows for lists of any size: a list
    with a NULL hides every key of the other side, and a NULL key shows up
    against an empty list only.
    """
    only_left = F.col("in_right").isNull()
    other = F.when(only_left, _kind(right, right_key)).otherwise(_kind(left, left_key))
    gaps = _both_sides(left, right, left_key, right_key).where("in_left is null or in_right is null")
    return gaps.select(
        F.when(only_left, labels[0]).otherwise(labels[1]).alias("source"),
        F.coalesce("ours", "theirs").alias("nom"), other.alias("other"),
    ).where((F.col("other") == EMPTY) | ((F.col("other") == COMPLETE) & F.col("nom").isNotNull())
            ).select("source", "nom").orderBy("source", "nom")
