"""Exact distinct counts from bitmaps: which places and towns each day has.

Places are numbered once, and a day keeps one bit per place and one per town,
in words of 64 numbers. Words that have no bit set are not kept, so there are
never more of them than readings, and an aggregation holds a few longs per word.
Sets of several days or loads merge by OR, so counts of any span need neither
the readings again nor one copy of each reading per counted column. A reading
replaced by another of its (day, place) leaves the sets as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from heatmart.operators.scale import cut_lineage

PLACE = ["code_insee", "ville", "departement", "region"]
# A bitmap holds 2 ** WORD numbers, the bits of a long.
WORD = 6


def numbered_places(table: DataFrame) -> DataFrame:
    """(place, town, code_insee, ville, departement, region): each distinct place with its number and its town's.

    Numbers have gaps between partitions, not within; no task sees all places.
    Both follow the order of towns, so the places of a word lie in few words of
    towns.
    """
    number = F.monotonically_increasing_id()
    numbered = cut_lineage(table.select(*PLACE).distinct().orderBy("ville", "code_insee", "departement", "region").select(number.alias("place"), *PLACE))
    named = numbered.where("ville is not null")
    towns = cut_lineage(named.select("ville").distinct().orderBy("ville").select("ville", number.alias("town")))
    nameless = numbered.where("ville is null").withColumn("town", F.lit(None).cast("long"))
    return cut_lineage(named.join(towns, "ville").unionByName(nameless).select("place", "town", *PLACE))


def _or(column: str) -> Column:
    return F.bit_or(column).alias(column)


def _part(number: str) -> Column:
    """The word that a number lies in."""
    return F.shiftright(number, WORD)


def _bit(number: str) -> Column:
    """A word with this number's bit alone."""
    return F.expr(f"shiftleft(1L, cast({number} & {2 ** WORD - 1} as int))")


def presence(panel: DataFrame, places: DataFrame) -> DataFrame:
    """(date, place_part, town_part, places, towns, lignes): a day's bitmaps, and its rows.

    A bitmap is a word of 64 numbers; more places make more parts. With a column
    ``sign``, rows that go are subtracted from lignes; they only ever make
    room for a row of the same day and place, so their bits stay.
    """
    sign = F.col("sign") if "sign" in panel.columns else F.lit(1)
    known = places.select("place", "town", *[F.col(c).alias(f"_{c}") for c in PLACE])
    met = panel.join(known, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE])
    return met.groupBy(F.to_date("date").alias("date"), _part("place").alias("place_part"), _part("town").alias("town_part")).agg(
        F.bit_or(_bit("place")).alias("places"), F.bit_or(_bit("town")).alias("towns"),
        F.sum(sign).cast("long").alias("lignes"))


def merged(stored: DataFrame, added: DataFrame) -> DataFrame:
    return stored.unionByName(added).groupBy("date", "place_part", "town_part").agg(
        _or("places"), _or("towns"), F.sum("lignes").alias("lignes"))


def coverage(days: DataFrame, places: DataFrame) -> DataFrame:
    """Size and extent of the panel in one row, as quality.coverage() has it."""
    size = days.agg(F.coalesce(F.sum("lignes"), F.lit(0)).alias("total_lignes"), F.min("date").alias("date_min"), F.max("date").alias("date_max"))
    dates = days.select("date").distinct().agg(F.count("date").alias("nb_jours"))
    towns = days.where("town_part is not null").groupBy("town_part").agg(_or("towns")).agg(
        F.coalesce(F.sum(F.bit_count("towns")), F.lit(0)).alias("nb_communes"))
    seen = days.groupBy("place_part").agg(_or("places"))
    # places are a list of a country's, already without readings
    there = places.join(seen, _part("place") == F.col("place_part")).where(F.col("places").bitwiseAND(_bit("place")) != 0)
    names = {"nb_codes_insee": "code_insee", "nb_departements": "departement", "nb_regions": "region"}
    entries = F.array(*[F.struct(F.lit(n).alias("n"), F.col(c).alias("v")) for n, c in names.items()])
    values = there.select(F.inline(entries)).where("v is not null").distinct()
    counts = values.agg(*[F.count_if(F.col("n") == n).alias(n) for n in names])
    parts = size
    for part in (towns, counts, dates):
        parts = parts.unionByName(part, allowMissingColumns=True)
    # each figure is there once
    order = ["total_lignes", "nb_communes", "nb_codes_insee", "nb_departements", "nb_regions", "date_min", "date_max", "nb_jours"]
    return parts.agg(*[F.max(c).alias(c) for c in order])


def _towns_by_day(days: DataFrame) -> DataFrame:
    parts = days.groupBy("date", "town_part").agg(_or("towns"), F.sum("lignes").alias("lignes"))
    # readings without a town have a part of their own, without a bitmap
    towns = F.coalesce(F.bit_count("towns"), F.lit(0))
    return parts.groupBy("date").agg(F.sum(towns).alias("n"), F.sum("lignes").alias("lignes"))


def key_uniqueness(days: DataFrame) -> DataFrame:
    """Rows against distinct complete (date, ville)."""
    return _towns_by_day(days).agg(
        F.coalesce(F.sum("lignes"), F.lit(0)).alias("total_lignes"),
        F.coalesce(F.sum(F.when(F.col("date").isNotNull(), F.col("n"))), F.lit(0)).alias("couples_uniques"),
    ).withColumn("doublons", F.col("total_lignes") - F.col("couples_uniques"))


def incomplete_days(days: DataFrame, expected: int = 360) -> DataFrame:
    """Days on which fewer towns than expected report."""
    return (_towns_by_day(days).select(F.col("date").alias("jour"), F.col("n").alias("nb_communes"))
            .where(F.col("nb_communes") < expected).orderBy("jour"))


def continuity(days: DataFrame) -> DataFrame:
    """Days present against days between first and last."""
    return days.select("date").distinct().agg(
        F.min("date").alias("date_min"), F.max("date").alias("date_max"), F.count("date").alias("jours_presents"),
    ).withColumn("jours_attendus", F.datediff("date_max", "date_min") + 1
                 ).withColumn("jours_manquants", F.col("jours_attendus") - F.col("jours_presents"))
