"""Reports from monthly states: sums, counts and peaks per (month, department, region) that changes are merged into.

Measures of the fact have two decimals, so they are summed as whole
hundredths: a row that goes is subtracted exactly. A peak cannot be
subtracted; groups that lose theirs are counted anew from the fact, all others
are not read again. The table has as many rows as the calendar has months,
times departments, whatever the number of readings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from heatmart.functions.numeric import no_nan, round_to
from heatmart.sources.changes import SIGN

KEYS = ["date_month", "departement", "region"]
SUMMED = ["temperature_moyenne", "temperature_maximale", "temperature_minimale", "humidite_moyenne", "precipitations_totales"]
# Degrees that make a day count as hot.
HOT = (30, 35, 40)


def _hundredths(measure: str) -> Column:
    return F.rint(no_nan(F.col(measure)) * 100).cast("long")


def _present(panel: DataFrame) -> list[str]:
    return [m for m in SUMMED if m in panel.columns]


def deltas(changes: DataFrame) -> DataFrame:
    """What rows with a sign add to the states; peaks of coming and of going rows are kept apart."""
    rows = changes.withColumn("date_month", F.trunc("date", "MM"))
    keys = [k for k in KEYS if k in rows.columns]
    sign, hot = F.col(SIGN), F.col("temperature_maximale")
    sums: dict[str, Column] = {"lignes": F.sum(sign)}
    for m in _present(rows):
        sums[f"n_{m}"] = F.sum(F.when(no_nan(F.col(m)).isNotNull(), sign).otherwise(0))
        sums[f"somme_{m}"] = F.sum(F.coalesce(_hundredths(m) * sign, F.lit(0)))
    for t in HOT:
        sums[f"jours_sup_{t}"] = F.sum(F.when(hot > t, sign).otherwise(0))
    peak = no_nan(hot)
    return rows.groupBy(*keys).agg(
        *[c.cast("long").alias(n) for n, c in sums.items()],
        F.max(F.when(sign == 1, peak)).alias("come"), F.max(F.when(sign == -1, peak)).alias("gone"))


def states(panel: DataFrame) -> DataFrame:
    """The states of a whole panel."""
    return deltas(panel.withColumn(SIGN, F.lit(1))).withColumnRenamed("come", "pic").drop("gone")


def merged(stored: DataFrame, added: DataFrame, recount: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stored states with deltas added.

    ``recount`` gives the states of the groups whose peak went, from a table
    that has the changes already.
    """
    keys = [k for k in KEYS if k in stored.columns]
    none = F.lit(None).cast("double")
    sums = [c for c in stored.columns if c not in (*keys, "pic")]
    both = (stored.withColumn("come", none).withColumn("gone", none)
            .unionByName(added.withColumn("pic", none)))
    held, come, gone = F.max("pic"), F.max("come"), F.max("gone")
    lost = F.coalesce(gone >= held, F.lit(False)) & F.coalesce(come < gone, F.lit(True))
    total = both.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], F.greatest(held, come).alias("pic"), lost.alias("lost")).where("lignes <> 0")
    again = total.where("lost").select(*keys)
    sure = total.where("not lost").drop("lost")
    return sure.unionByName(recount(again).select(*sure.columns))


def of_groups(panel: DataFrame, groups: DataFrame) -> DataFrame:
    """States of some groups, NULL names included; only their months of the panel are read."""
    keys = [k for k in KEYS if k in groups.columns]
    # as many months as the calendar has
    months = [r[0] for r in groups.select("date_month").distinct().collect()]
    if not months:
        return states(panel.where(F.lit(False)))
    rows = panel.where(F.trunc("date", "MM").isin(months))
    rows = rows.where(F.col("date").between(F.lit(min(months)), F.last_day(F.lit(max(months)))))
    wanted = groups.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return states(rows).join(wanted, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_semi")


# ---- reports ------------------------------------------------------------------


def _mean(measure: str) -> Column:
    return F.try_divide(F.sum(f"somme_{measure}") / 100, F.sum(f"n_{measure}"))


def _year() -> Column:
    return F.year("date_month").alias("annee")


def yearly_trend(table: DataFrame) -> DataFrame:
    return table.groupBy(_year()).agg(
        round_to(_mean("temperature_moyenne"), 2).alias("temp_moyenne_annuelle"),
        round_to(_mean("temperature_maximale"), 2).alias("temp_max_moyenne"),
        round_to(F.max("pic"), 1).alias("temp_max_absolue")).orderBy("annee")


def seasonality(table: DataFrame) -> DataFrame:
    names = {"temp_moy": "temperature_moyenne", "temp_max": "temperature_maximale", "temp_min": "temperature_minimale"}
    return table.groupBy(F.month("date_month").alias("mois")).agg(*[_mean(c).alias(n) for n, c in names.items()]).orderBy("mois")


def heat_days_by_year(table: DataFrame) -> DataFrame:
    """Commune-days above 30, 35 and 40 degrees, and departments touched above 35."""
    return table.groupBy(_year()).agg(
        *[F.sum(f"jours_sup_{t}").alias(f"jours_sup_{t}") for t in HOT],
        F.countDistinct(F.when(F.col("jours_sup_35") > 0, F.col("departement"))).alias("depts_touches_35")).orderBy("annee")


def heat_days_by_month(table: DataFrame) -> DataFrame:
    return table.groupBy(F.month("date_month").alias("mois")).agg(F.sum("jours_sup_35").alias("jours_sup_35")).orderBy("mois")


def department_year(table: DataFrame) -> DataFrame:
    return table.groupBy(_year(), "departement").agg(
        round_to(_mean("temperature_moyenne"), 2).alias("temp_moyenne_annuelle"),
        round_to(F.max("pic"), 1).alias("temp_max_absolue"),
        F.sum("jours_sup_35").alias("jours_sup_35"), F.sum("jours_sup_30").alias("jours_sup_30"),
        round_to(_mean("humidite_moyenne"), 1).alias("humidite_moyenne"),
        round_to(F.when(F.sum("n_precipitations_totales") > 0, F.sum("somme_precipitations_totales") / 100), 1)
        .alias("precipitations_annuelles"))


def department_summer(table: DataFrame) -> DataFrame:
    """Means over June to September."""
    return table.where(F.month("date_month").between(6, 9)).groupBy(_year(), "departement").agg(
        round_to(_mean("temperature_moyenne"), 2).alias("temp_moyenne_ete"),
        round_to(_mean("temperature_maximale"), 2).alias("temp_max_moyenne_ete"))
