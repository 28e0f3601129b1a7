"""Place resolution: messy point and town names to official commune codes.

A reading names its place by official code, by point name or by town name. The
match depends on that pair of texts only, so it is worked out once per distinct
pair (thousands) instead of once per reading (billions): folding and matching
run on a two-column distinct, which Spark reduces map-side, and the readings
then take one join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from heatmart.functions.text import fold_name, lookup_code, lookup_name
from heatmart.operators.scale import (
    BROADCAST_BYTES, cut_lineage, spread_nulls, stored_and_measured)

PLACE = ["nom_poi", "ville"]
TARGET = ["code_insee", "commune", "numero_departement", "latitude", "longitude"]


def match_places(readings: DataFrame, communes: DataFrame,
                 limit: int = BROADCAST_BYTES) -> DataFrame:
    """Each distinct place with every commune it stands for.

    Priority: code, then point name, then town name. A later key is looked up
    only where the earlier ones found nothing, so a widely shared name is not
    paired with places that do not need it. A commune without department takes
    the department of the next match.
    """
    # the folded commune list serves every look-up, so it is stored and measured once
    named, size = stored_and_measured(communes.select(
        "code_insee", F.col("ville").alias("commune"), "numero_departement",
        "latitude", "longitude", fold_name(F.col("ville")).alias("name_key"),
    ), bare=F.count_if(F.col("numero_departement").isNull()))
    small = size["bytes"] <= limit
    target = F.struct(*TARGET)

    def look_up(left: DataFrame, key: Column, right: DataFrame) -> DataFrame:
        """Left join on ``key`` with the first column of ``right``."""
        at = right.columns[0]
        spread = spread_nulls(key, F.col("nom_poi"), F.col("ville"))
        if small:
            return left.join(F.broadcast(right), spread == F.col(at), "left")
        # An outer join can only split its left side, but a name may be hot in the
        # commune list: hits come from an inner join, which splits both sides.
        left = cut_lineage(left)
        hits = left.join(right, key == F.col(at))
        misses = left.join(right.select(at).distinct(), spread == F.col(at), "left_anti")
        return hits.unionByName(misses, allowMissingColumns=True)

    places = readings.select(*PLACE).distinct().select(
        *PLACE, lookup_code(F.col("nom_poi")).alias("k1"),
        lookup_name(F.col("nom_poi")).alias("k2"),
        fold_name(F.col("ville").cast("string")).alias("k3"))
    c1, c2, c3 = F.col("c1"), F.col("c2"), F.col("c3")
    found = look_up(places, F.col("k1"),
                    named.select(F.col("code_insee").alias("at1"), target.alias("c1")))
    found = look_up(found, F.when(c1.isNull(), F.col("k2")),
                    named.select(F.col("name_key").alias("at2"), target.alias("c2")))
    found = look_up(found, F.when(c1.isNull() & c2.isNull(), F.col("k3")),
                    named.select(F.col("name_key").alias("at3"), target.alias("c3")))
    found = found.select(*PLACE, "k2", "k3", "c1", "c2", F.coalesce(c1, c2, c3).alias("to"))
    found = found.where("to is not null")
    department = F.col("to.numero_departement")

    if size["bare"]:
        departments = named.select("name_key", "numero_departement").distinct()
        bare = department.isNull()
        found = look_up(found, F.when(bare & c1.isNotNull(), F.col("k2")),
                        departments.toDF("at4", "d2"))
        found = look_up(found, F.when(bare & F.col("d2").isNull() & F.coalesce(c1, c2).isNotNull(),
                                      F.col("k3")), departments.toDF("at5", "d3"))
        department = F.coalesce(department, "d2", "d3")
    matched = found.select(*PLACE, "to.code_insee", "to.commune",
                           department.alias("numero_departement"), "to.latitude", "to.longitude")
    return matched.distinct()


@dataclass
class PlaceMap:
    """A matched place table in the shared folder, with its measured size.

    ``several`` holds the places that stand for more than one commune.
    """

    table: DataFrame
    several: DataFrame
    small: bool
    branching: bool

    def part(self, branching: bool) -> DataFrame:
        if not self.branching:
            return self.table
        several = F.broadcast(self.several) if self.small else self.several
        return self.table.join(several, _same_place(), "left_semi" if branching else "left_anti")


def _same_place() -> Column:
    return (F.col("nom_poi").eqNullSafe(F.col("_nom_poi"))
            & F.col("ville").eqNullSafe(F.col("_ville")))


def place_map(readings: DataFrame, communes: DataFrame,
              limit: int = BROADCAST_BYTES) -> PlaceMap:
    table, size = stored_and_measured(match_places(readings, communes, limit))
    several = (table.groupBy(*PLACE).agg(F.count("*").alias("n")).where("n > 1")
               .select(*[F.col(c).alias(f"_{c}") for c in PLACE]))
    return PlaceMap(table, several, size["bytes"] <= limit, not several.isEmpty())


def attach(readings: DataFrame, places: DataFrame, small: bool) -> DataFrame:
    """Readings with the communes of their place; readings without one drop out.

    The pair is compared NULL-safe. A place table too big to broadcast meets
    the readings in a shuffle join, where adaptive execution splits hot places.
    """
    right = places.select(*[F.col(c).alias(f"_{c}") for c in PLACE],
                          *[F.col(c).alias(f"_to_{c}") for c in TARGET])
    joined = readings.join(F.broadcast(right) if small else right, _same_place())
    kept = [F.col(c) for c in readings.columns if c not in {*PLACE, *TARGET}]
    return joined.select(*kept, *[F.col(f"_to_{c}").alias("ville" if c == "commune" else c)
                                  for c in TARGET])


def resolve_places(readings: DataFrame, communes: DataFrame,
                   limit: int = BROADCAST_BYTES) -> DataFrame:
    """Readings enriched with code, name, department and coordinates.

    A name borne by several communes yields one row for each of them.
    """
    places = place_map(readings, communes, limit)
    return attach(readings, places.table, places.small)


def resolve_best(readings: DataFrame, communes: DataFrame, choose,
                 limit: int = BROADCAST_BYTES) -> DataFrame:
    """resolve_places for callers that keep one reading per (day, commune) anyway.

    ``choose(df, keys)`` keeps the best reading per key. Readings of a shared
    name are first reduced to the best one per (day, place): only that one can
    win in any of the communes, and a popular name held by a large part of all
    readings no longer multiplies by its bearers.
    """
    places = place_map(readings, communes, limit)
    single = attach(readings, places.part(False), places.small)
    if not places.branching:
        return single
    names = F.broadcast(places.several) if places.small else places.several
    shared = choose(readings.join(names, _same_place(), "left_semi"), ["date", *PLACE])
    return single.unionByName(attach(shared, places.part(True), places.small))
