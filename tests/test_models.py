"""Staging, place resolution and marts on hand-written rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from heatmart import schemas
from heatmart.operators import resolve
from heatmart.operators.scale import cut_lineage
from heatmart.plans import marts, staging
from heatmart.plans.build import Raw, build
from support import plan, rows

COMMUNES = [
    # code, name, department, region, department number, latitude, longitude, centroid, service
    ("1034", "Belley", "Ain", "Auvergne-Rhône-Alpes", "01", 45.7, 5.6, None, "SDIS01"),
    ("2A004", "Ajaccio", "Corse-du-Sud", "Corse", "2A", 41.9, 8.7, None, None),
    ("2a004", "Ajaccio", "Corse-du-Sud", "Corse", "2A", 41.9, 8.7, None, None),
    ("04070", "Digne-les-bains", "Alpes", "Provence-Alpes-Côte d'Azur", "04", 44.0, 6.2, None, None),
    ("48200", "Saint-Chely-d-Apcher ", "Lozère", "Occitanie", "48", 44.8, 3.2, None, None),
    ("75056", "Paris", "Paris", "Île-de-France", "75", 48.8, 2.3, None, "B"),
    ("75056", "Paris", "Paris", "Île-de-France", "75", 48.8, 2.3, None, "A"),
    ("11001", "Saint-Denis", "Aude", "Occitanie", "11", 43.3, 2.2, None, None),
    ("22002", "Saint-Denis", "Côtes", "Bretagne", "22", 48.2, -2.9, None, None),
    ("33003", "Tab\t", "Gironde", None, "33", 44.8, -0.6, None, None),
    ("44004", " ", "Loire", "Pays", "44", 47.2, -1.5, None, None),
    ("55005", "X", "Meuse", "Est", "55", None, 5.1, None, None),
    ("123456", "Y", "Nord", "Hauts", "59", 50.6, 3.1, None, None),
    ("66006", "Z", "Pyrénées", "Occitanie", None, 42.7, 2.9, None, None),
    (None, "Sans code", "Nord", "Hauts", "59", 50.6, 3.1, None, None),
]
POINTS = {  # (point name, town name) -> codes
    ("1034", None): ["01034"], ("2A004", None): ["2A004"],
    ("2a004", "Ajaccio"): ["2A004", "2a004"], ("Digne-les-Bains", None): ["04070"],
    ("Saint-Chely-d'Apcher", None): ["48200"], (None, "SAINT CHELY D APCHER"): ["48200"],
    ("99999", "Paris"): ["75056"], ("66006", "Paris"): ["66006"],
    ("Saint-Denis", None): ["11001", "22002"], ("Nowhere", None): [], (None, None): [],
    ("1034\n", None): [], ("1034", "Saint-Denis"): ["01034"], ("66006", "Saint-Denis"): ["66006"] * 2,
    ("!", None): [], ("Tab", "Paris"): ["33003"],
}


@pytest.fixture(scope="module")
def raw_communes(spark):
    return spark.createDataFrame(COMMUNES, schemas.RAW_COMMUNES)


@pytest.fixture(scope="module")
def communes(raw_communes):
    return cut_lineage(staging.stg_communes(raw_communes))


def readings(spark, items):
    """items: (day, point, town, maximum, felt maximum, mean)"""
    cols = ["time", "nom_poi", "ville", "temperature_2m_max", "apparent_temperature_max",
            "temperature_2m_mean"]
    named = [dict(zip(cols, i)) for i in items]
    return spark.createDataFrame([tuple(n.get(f.name) for f in schemas.RAW_WEATHER.fields)
                                  for n in named], schemas.RAW_WEATHER)


def test_stg_communes(communes):
    got = {r.code_insee: r for r in communes.collect()}
    assert set(got) == {"01034", "2A004", "2a004", "04070", "48200", "75056", "11001", "22002",
                        "33003", "12345", "66006"}
    assert got["75056"].service == "A" and got["33003"].ville == "Tab"
    assert got["48200"].ville == "Saint-Chely-d-Apcher"


def test_stg_communes_does_not_depend_on_partitioning(raw_communes):
    kept = [c for c in staging.stg_communes(raw_communes).columns
            if c not in schemas.AUDIT_COLUMNS]
    one = rows(staging.stg_communes(raw_communes).select(*kept))
    two = rows(staging.stg_communes(raw_communes.orderBy(F.desc("Service")).repartition(7))
               .select(*kept))
    assert one == two


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, 0], ids=["broadcast", "shuffle"])
def test_place_resolution(spark, communes, limit):
    day = datetime(2026, 8, 1)
    raw = readings(spark, [(day, p, t, 30.0, 31.0, 25.0) for p, t in POINTS])
    listed = raw.select("nom_poi", "ville", F.monotonically_increasing_id().alias("i"))
    listed = listed.withColumn("point", F.col("nom_poi")).withColumn("town", F.col("ville"))
    got = {}
    for r in resolve.resolve_places(listed, communes, limit).collect():
        got.setdefault((r.point, r.town), []).append(r.code_insee)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in POINTS.items() if v}


def naive(raw, communes):
    """The three outer joins written out, for comparison."""
    from heatmart.functions.text import fold_name, lookup_code, lookup_name
    ref = communes.select("code_insee", "ville", "numero_departement", "latitude", "longitude",
                          fold_name(F.col("ville")).alias("name"))
    left = raw.select("id", F.col("nom_poi").alias("p"), F.col("ville").alias("t"))
    left = (left.withColumn("k1", lookup_code(F.col("p"))).withColumn("k2", lookup_name(F.col("p")))
            .withColumn("k3", fold_name(F.col("t"))))
    for i, key in ((1, "code_insee"), (2, "name"), (3, "name")):
        side = ref.select(*[F.col(c).alias(f"{c}{i}") for c in ref.columns])
        left = left.join(side, F.col(f"k{i}") == F.col(f"{key}{i}"), "left")
    return left.select("id", *[F.coalesce(*[f"{c}{i}" for i in (1, 2, 3)]).alias(c) for c in
                               ref.columns[:-1]]).where("code_insee is not null").distinct()


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, 0], ids=["broadcast", "shuffle"])
def test_place_resolution_equals_three_outer_joins(spark, communes, limit):
    points = [p for p, _ in POINTS] + ["Z", "", "66006"]
    towns = [t for _, t in POINTS] + ["Z", "Ajaccio", ""]
    pairs = sorted({(p, t) for p in points for t in towns}, key=repr)
    raw = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(pairs)],
                                "id int, nom_poi string, ville string")
    got = resolve.resolve_places(raw, communes, limit)
    assert rows(got.select("id", *naive(raw, communes).columns[1:])) == rows(naive(raw, communes))


def test_department_comes_from_next_match(spark, communes):
    raw = spark.createDataFrame([("66006", "Paris"), ("66006", "Saint-Denis"), ("66006", None)],
                                "nom_poi string, ville string")
    got = resolve.resolve_places(raw, communes)
    assert rows(got.select("ville", "numero_departement")) == sorted(
        [("Z", "75"), ("Z", "11"), ("Z", "22"), ("Z", None)], key=repr)


DAY, NEXT = datetime(2026, 8, 1), datetime(2026, 8, 2)
DUPLICATES = [
    (DAY, "1034", None, None, 40.0, 9.0), (DAY, "Belley", None, 30.0, None, 8.0),
    (DAY, None, "BELLEY", 29.0, 33.0, 7.0), (DAY, "1034", None, 28.0, 33.0, 7.5),
    (DAY, "Saint-Denis", None, None, None, 3.0), (DAY, "saint denis", None, 20.0, 21.0, 2.0),
    (DAY, "11001", None, 19.0, 21.0, 1.0), (NEXT, "Saint-Denis", None, 5.0, None, 4.0),
    (None, "1034", None, 1.0, 1.0, 1.0), (NEXT, "Nowhere", None, 1.0, 1.0, 1.0),
]


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, 0], ids=["broadcast", "shuffle"])
def test_stg_weather_keeps_best_reading(spark, communes, limit):
    got = staging.stg_weather(readings(spark, DUPLICATES), communes, limit)
    assert rows(got.select("date", "code_insee", "temperature_max", "temperature_moyenne")) == [
        (date(2026, 8, 1), "01034", 29.0, 7.0), (date(2026, 8, 1), "11001", 19.0, 1.0),
        (date(2026, 8, 1), "22002", 20.0, 2.0), (date(2026, 8, 2), "11001", 5.0, 4.0),
        (date(2026, 8, 2), "22002", 5.0, 4.0)]


def test_stg_weather_does_not_depend_on_order(spark, communes):
    def run(items, n):
        got = staging.stg_weather(readings(spark, items).repartition(n), communes)
        return rows(got.drop("inserted_at"))
    assert run(DUPLICATES, 1) == run(DUPLICATES[::-1], 6)


def test_plan_of_stg_weather(spark, communes):
    text = plan(staging.stg_weather(readings(spark, DUPLICATES), communes))
    assert "BroadcastHashJoin" in text and "Python" not in text and "ArrowEval" not in text
    # the group limit sits below the exchange as well: hot keys shrink before the shuffle
    assert text.count("WindowGroupLimit") >= 2 and "CartesianProduct" not in text


def test_plan_without_broadcast_stays_an_equi_join(spark, communes):
    text = plan(staging.stg_weather(readings(spark, DUPLICATES), communes, 0))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_region_keys_of_indicators_are_worked_out_per_name(spark):
    day = date(2024, 1, 1)
    items = [(day, "84", n, "a", "b", "c", v) for v, n in enumerate(["Île-de-France", None, "Île-de-France", "Réunion", None, "\u0000"])]
    raw = spark.createDataFrame([*items, (None, "84", "Est", "a", "b", "c", 1), (day, "84", "Sud", "a", "b", "c", None)],
                                "date date, reg string, nom_region string, sous_chapitre string, theme string, indicateur string, valeur long")
    got = staging.stg_winter(raw)
    assert rows(got.select("valeur", "nom_region", "region_key")) == [
        (0, "Île-de-France", "ILE-DE-FRANCE"), (1, None, None), (2, "Île-de-France", "ILE-DE-FRANCE"),
        (3, "Réunion", "REUNION"), (4, None, None), (5, "\u0000", "\u0000")]
    assert got.columns == ["date", "reg", "nom_region", "region_key", "sous_chapitre", "theme", "indicateur", "valeur", "loaded_at"]
    # folding a name is no part of the plan of the rows
    assert "translate(" not in plan(got)


def test_marts(spark, communes):
    regions = rows(marts.dim_region(communes).select("nom_region", "region_key"))
    assert ("Île-de-France", "ILE-DE-FRANCE") in regions and len(regions) == 7
    raw = readings(spark, DUPLICATES)
    days = rows(marts.dim_date(raw).drop("inserted_at"))
    assert days == [
        (date(2026, 8, 1), 2026, 8, "Août", date(2026, 8, 1), 7, True),
        (date(2026, 8, 2), 2026, 8, "Août", date(2026, 8, 1), 1, True)]
    fact = marts.fct_daily(staging.stg_weather(raw, communes))
    assert fact.columns[-2:] == ["inserted_at", "updated_at"]
    wide = marts.wide(fact, communes)
    assert {"departement", "region", "temperature_maximale", "duree_ensoleillement",
            "pluie_totale"} <= set(wide.columns)


def test_build_writes_every_table(spark, raw_communes, tmp_path):
    health = spark.createDataFrame([(date(2020, 1, 1), "Ain", "01", "84", "Rhône", 3.0),
                                    (date(2020, 1, 1), "Aude", "11", "76", "Occ", None)],
                                   schemas.RAW_HEAT_HEALTH)
    winter = spark.createDataFrame([(date(2020, 1, 1), "84", "Rhône", "a", "b", "c", 1.0)],
                                   schemas.RAW_WINTER)
    stored = build(spark, Raw(readings(spark, DUPLICATES), raw_communes, health, winter),
                   str(tmp_path))
    assert {n: df.count() for n, df in stored.items()} == {
        "stg_communes": 11, "dim_commune": 11, "dim_region": 7, "dim_date": 2,
        "stg_heat_health": 1, "stg_winter": 1, "stg_weather": 5, "fct_daily": 5}
    stamped = stored["fct_daily"].select("inserted_at", "updated_at").distinct()
    assert stamped.count() == 1
