"""The given tables recast to the shapes of the raw weather and health tables.

Only projections, joins on keys and recodings by value: every row takes part.
Spelling differs on purpose between the reading side and the commune list, so
that names meet only after folding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer with nation and region names (25 and 5 rows, fixed in size)."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    return (table(spark, sf_dir, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey")))


def raw_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commune list in which every commune is listed twice, once per service.

    Customers in debt bear a name two neighbouring keys share; some lack
    coordinates, some a department.
    """
    listed = places(spark, sf_dir).selectExpr(
        "cast(c_custkey as string) as `code INSEE`",
        """case when c_acctbal < 0 then '  Saint Denis ' || (c_custkey div 2)
                else '  Ile-d Evry-' || c_custkey end || '\t' as Commune""",
        "' ' || n_name as Departement",
        "r_name || ' ' as `Région`",
        "case when c_acctbal <= 9000 then cast(c_nationkey as string) end as Numero_Departement",
        "case when c_acctbal >= -950 then c_acctbal / 200 end as Latitude",
        "c_acctbal / 100 as Longitude",
        "cast(c_acctbal as string) as Centroide",
        "c_mktsegment as Segment")
    services = F.explode(F.array(F.lit("SDIS "), F.lit("SAMU ")))
    return (listed.withColumn("Service", services)
            .withColumn("Service", F.concat("Service", "Segment")).drop("Segment"))


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily readings: an order is a reading taken at its customer's place."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    name = ("case when c_acctbal < 0 then 'SAINT-Denis ' || (c_custkey div 2) "
            "else 'Île d''Évry ' || c_custkey end")
    return orders.selectExpr(
        "case when o_totalprice >= 1500 then o_orderdate end as time",
        f"case o_orderstatus when 'F' then cast(c_custkey as string) when 'O' then {name} end"
        " as nom_poi",
        f"case when o_orderstatus = 'F' then 'ÎLE D’ÉVRY ' || (c_custkey + 1)"
        f" when o_orderpriority <> '5-LOW' then {name} end as ville",
        "c_acctbal / 200 as latitude_poi", "c_acctbal / 100 as longitude_poi",
        "cast(c_nationkey as string) as numero_departement",
        "cast(o_orderkey % 100 as double) as weather_code",
        "o_totalprice / 10000 - 10 as temperature_2m_mean",
        "o_totalprice / 10000 - 15 as temperature_2m_min",
        "case when o_orderpriority <> '4-NOT SPECIFIED' then o_totalprice / 10000 - 5 end"
        " as temperature_2m_max",
        "o_totalprice / 10000 - 11 as apparent_temperature_mean",
        "case when o_orderpriority <> '2-HIGH' then o_totalprice / 10000 - 4 end"
        " as apparent_temperature_max",
        "cast((o_orderkey * 7) % 101 as double) as relative_humidity_2m_mean",
        "((o_orderkey * 3) % 211) / 8 as precipitation_sum",
        "((o_orderkey * 5) % 223) / 8 as rain_sum",
        "((o_custkey * 11) % 401) / 16 as wind_speed_10m_mean",
        "((o_custkey * 13) % 809) / 16 as wind_speed_10m_max",
        "((o_orderkey * 17) % 1201) / 16 as wind_gusts_10m_max",
        "980 + ((o_orderkey * 19) % 481) / 8 as pressure_msl_mean",
        "cast((o_orderkey * 23) % 50021 as double) as sunshine_duration",
        "o_orderkey as reading_id")


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide daily frame (day, commune, department, region, measures)."""
    panel = table(spark, sf_dir, "orders").join(
        places(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return panel.selectExpr(
        "to_date(o_orderdate) as date",
        "lpad(cast(c_custkey as string), 9, '0') as code_insee",
        "case when c_acctbal >= -900 then c_name end as ville",
        "case when c_acctbal <= 9900 then n_name end as departement",
        "case when c_acctbal <= 9800 then r_name end as region",
        "cast(c_nationkey as string) as numero_departement",
        "o_totalprice / 10000 - 10 as temperature_moyenne",
        "((o_orderkey * 29) % 601) / 16 - 15 as temperature_minimale",
        "case when o_orderpriority <> '4-NOT SPECIFIED' then o_totalprice / 10000 - 5 end"
        " as temperature_maximale",
        "case when o_orderpriority <> '2-HIGH' then cast((o_orderkey * 7) % 103 as double) end"
        " as humidite_moyenne",
        "((o_orderkey * 3) % 211) / 8 as precipitations_totales",
        "((o_orderkey * 5) % 223) / 8 as pluie_totale",
        "((o_custkey * 11) % 401) / 16 as vitesse_vent_moyenne",
        "((o_custkey * 13) % 809) / 16 as vitesse_vent_maximale",
        "980 + ((o_orderkey * 19) % 481) / 8 as pression_moyenne",
        "cast((o_orderkey * 23) % 50021 as double) as duree_ensoleillement",
        "case when o_orderstatus = 'P' then cast(o_custkey % 7 as int) end as deces",
        "case when o_orderstatus <> 'F' then cast(o_custkey % 11 as int) end as hospitalisations",
        "o_totalprice > 400000 as alerte")


def raw_heat_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heat-wave days: distinct ship days with a large quantity, per nation and year."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    counted = (table(spark, sf_dir, "lineitem")
               .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
               .groupBy(F.year("l_shipdate").alias("y"), "s_nationkey")
               .agg(F.countDistinct(F.expr("case when l_quantity > 45 then to_date(l_shipdate) end"))
                    .cast("double").alias("nb_j_can")))
    return (counted.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr("make_date(y, 1, 1) as annee", "n_name as libgeo",
                        "cast(s_nationkey as string) as dep",
                        "cast(n_regionkey as string) as reg", "r_name as nom_region",
                        "case when nb_j_can > 0 then nb_j_can end as nb_j_can"))


def raw_winter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "to_date(l_shipdate) as date", "cast(l_suppkey as string) as reg",
        "'Région ' || l_linestatus as nom_region", "l_linestatus as sous_chapitre",
        "cast(l_linenumber as string) as theme", "l_returnflag as indicateur",
        "case when l_linenumber <> 7 then l_quantity end as valeur")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with many copies per (day, place)."""
    return table(spark, sf_dir, "events").selectExpr(
        "to_date(ts) as date", "cast(user_id as string) as code_insee",
        "case when event_type <> 'error' then value end as temperature_max",
        "case when event_type <> 'click' then value + 1 end as temperature_ressentie_max",
        "event_type", "event_id", "ts")
