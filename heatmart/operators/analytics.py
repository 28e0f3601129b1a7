"""Heat days, seasons, trends and rankings over the daily panel.

Groups (months, years, departments) are few, so map-side aggregation leaves a
handful of rows per task to shuffle whatever the skew.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from heatmart.functions.dates import since_days
from heatmart.functions.numeric import no_nan, round_to
from heatmart.operators.dedup import ascending

def _year():
    return F.year("date").alias("annee")


def _hotter(limit: float):
    return F.col("temperature_maximale") > limit


def insertion_trace(log: DataFrame, loaded: str, day: str) -> DataFrame:
    """Rows per load day and the newest day each load brought."""
    return (log.where(F.col(loaded).isNotNull())
            .groupBy(F.to_date(loaded).alias("jour_insertion"))
            .agg(F.count("*").alias("lignes_inserees"),
                 F.max(F.to_date(day)).alias("donnee_la_plus_recente"))
            .orderBy(F.desc("jour_insertion")))


def run_history(fact: DataFrame, loaded: str = "inserted_at", day: str = "date",
                code: str = "code_insee", last: int = 30) -> DataFrame:
    """The last loads with rows, extent and communes."""
    return (fact.groupBy(F.to_date(loaded).alias("execution_date"))
            .agg(F.count("*").alias("rows_inserted"),
                 F.min(F.to_date(day)).alias("min_date"), F.max(F.to_date(day)).alias("max_date"),
                 F.countDistinct(code).alias("communes"))
            .orderBy(F.desc_nulls_last("execution_date")).limit(last))


def department_years(health: DataFrame, first: int = 10) -> DataFrame:
    """Years recorded per department, first departments by name."""
    return (health.groupBy("departement_nom", "departement_code")
            .agg(F.count("*").alias("nb_annees"))
            .orderBy(*ascending(["departement_nom", "departement_code"])).limit(first))


def seasonality(panel: DataFrame) -> DataFrame:
    """Monthly means of the three temperatures."""
    names = {"temp_moy": "temperature_moyenne", "temp_max": "temperature_maximale",
             "temp_min": "temperature_minimale"}
    return (panel.groupBy(F.month("date").alias("mois"))
            .agg(*[F.avg(no_nan(F.col(c))).alias(n) for n, c in names.items()]).orderBy("mois"))


def yearly_trend(panel: DataFrame) -> DataFrame:
    return (panel.groupBy(_year()).agg(
        round_to(F.avg("temperature_moyenne"), 2).alias("temp_moyenne_annuelle"),
        round_to(F.avg("temperature_maximale"), 2).alias("temp_max_moyenne"),
        round_to(F.max("temperature_maximale"), 1).alias("temp_max_absolue")).orderBy("annee"))


def linear_trend(yearly: DataFrame, before: int) -> DataFrame:
    """Straight line through the yearly means of complete years."""
    y, x = F.col("temp_moyenne_annuelle"), F.col("annee").cast("double")
    return (yearly.where(F.col("annee") < before)
            .agg(F.regr_slope(y, x).alias("pente"), F.regr_intercept(y, x).alias("ordonnee"))
            .withColumn("par_decennie", F.col("pente") * 10))


def department_climate(panel: DataFrame, first: int, last: int) -> DataFrame:
    """Climate per department over a span of years, warmest first."""
    return (panel.where(F.year("date").between(first, last)).groupBy("departement", "region").agg(
        round_to(F.avg("temperature_moyenne"), 2).alias("temp_moyenne"),
        round_to(F.max("temperature_maximale"), 1).alias("temp_max_absolue"),
        round_to(F.avg("humidite_moyenne"), 1).alias("humidite_moyenne"),
        F.countDistinct("ville").alias("nb_communes"))
        .orderBy(F.desc_nulls_last("temp_moyenne")))


def region_climate(departments: DataFrame) -> DataFrame:
    """Unweighted roll-up of department figures to regions, coolest first."""
    return (departments.where("region is not null").groupBy("region").agg(
        F.avg("temp_moyenne").alias("temp_moyenne"), F.max("temp_max_absolue").alias("temp_max"),
        F.count("departement").alias("nb_depts")).orderBy(F.asc_nulls_last("temp_moyenne")))


def warmest_and_coolest(departments: DataFrame, n: int = 15) -> DataFrame:
    """The n warmest and n coolest departments; names settle equal means."""
    known = departments.where("temp_moyenne is not null")
    names = ascending(["departement", "region"])
    warm = known.orderBy(F.desc("temp_moyenne"), *names).limit(n)
    cool = known.orderBy("temp_moyenne", *names).limit(n)
    kept = ["departement", "region", "temp_moyenne"]
    return (warm.select(F.lit("chaud").alias("cote"), *kept)
            .unionByName(cool.select(F.lit("frais").alias("cote"), *kept)))


def heat_days_by_year(panel: DataFrame) -> DataFrame:
    """Commune-days above 30, 35 and 40 degrees, and departments touched above 35."""
    return (panel.groupBy(_year()).agg(
        *[F.count_if(_hotter(t)).alias(f"jours_sup_{t}") for t in (30, 35, 40)],
        F.countDistinct(F.when(_hotter(35), F.col("departement"))).alias("depts_touches_35"))
        .orderBy("annee"))


def heat_days_by_month(panel: DataFrame) -> DataFrame:
    return (panel.groupBy(F.month("date").alias("mois"))
            .agg(F.count_if(_hotter(35)).alias("jours_sup_35")).orderBy("mois"))


def heat_waves(panel: DataFrame, thresholds: DataFrame, days: int = 3) -> DataFrame:
    """Department-days whose trailing mean of minimum and maximum both exceed the thresholds.

    Departments are reduced to one row per day before the window, so a window
    group holds a calendar, not readings. A mean counts only when all its days
    are there.
    """
    daily = (panel.where("departement is not null").groupBy("departement", "date").agg(
        F.avg("temperature_minimale").alias("low"), F.avg("temperature_maximale").alias("high")))
    trailing = (Window.partitionBy("departement").orderBy(F.datediff("date", F.lit("1970-01-01")))
                .rangeBetween(1 - days, 0))
    means = daily.select(
        "departement", "date",
        *[F.when(F.count(c).over(trailing) == days, F.avg(c).over(trailing)).alias(n)
          for c, n in (("low", "moyenne_min"), ("high", "moyenne_max"))])
    return (means.join(thresholds, "departement")
            .where("moyenne_min > seuil_min and moyenne_max > seuil_max"))


def period_region(panel: DataFrame) -> DataFrame:
    """Health and heat per month and region; missing counts are zero."""
    filled = panel.na.fill(0, ["deces", "hospitalisations"])
    return (filled.groupBy(F.date_format("date", "yyyyMM").alias("period_key"), "region").agg(
        F.sum("deces").alias("total_deaths"),
        F.sum("hospitalisations").alias("total_hospitalizations"),
        round_to(F.avg("temperature_moyenne"), 2).alias("avg_temperature"),
        F.max("temperature_maximale").alias("max_temperature"),
        F.countDistinct(F.when(F.col("alerte"), F.col("date"))).alias("alert_days")))


def volume_log(log: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Rows and billed gibibytes per day of a job log, latest first."""
    return (log.where(since_days(F.to_date("ts"), as_of, days))
            .groupBy(F.to_date("ts").alias("day"))
            .agg(F.count("*").alias("rows_processed"),
                 (F.sum("bytes") / F.lit(1024.0 ** 3)).alias("gb_billed"))
            .orderBy(F.desc("day")))
