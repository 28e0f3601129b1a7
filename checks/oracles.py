"""SQL counterparts of the queries, for an independent engine over the same tables."""

from __future__ import annotations

from heatmart import schemas

SQL: dict[str, str] = {}


def rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def six(expr: str) -> str:
    """Six decimals, ties kept off the boundary as in the queries."""
    return f"round(({expr}) * 1e6 + 0.001) / 1e6 + 0.0"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def plain(expr: str) -> str:
    """Upper case without diacritics."""
    return f"strip_accents(upper({expr}))"


def fold(expr: str) -> str:
    return f"regexp_replace({plain(expr)}, '[^A-Z0-9]', '', 'g')"


def trim(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def padded(expr: str, width: int) -> str:
    return f"CASE WHEN length({expr}) < {width} THEN lpad({expr}, {width}, '0') ELSE {expr} END"


def code_key(expr: str) -> str:
    return (f"CASE WHEN regexp_matches({expr}, '^[0-9]+$') THEN lpad({expr}, 5, '0') "
            f"WHEN regexp_matches({expr}, '^2[AB][0-9]{{3}}$') THEN {expr} END")


def point_key(expr: str) -> str:
    return f"CASE WHEN NOT regexp_matches({expr}, '^[0-9]') THEN {fold(expr)} END"


def collector(expr: str) -> str:
    t = trim(expr)
    return (f"CASE WHEN {t} = '' THEN NULL "
            f"WHEN length({t}) = 5 AND upper({t}[1:2]) IN ('2A', '2B') THEN upper({t}) "
            f"WHEN regexp_matches({t}, '^[0-9]+$') THEN {padded(t, 5)} ELSE {t} END")


# ---- shapes, as in the adapters ----------------------------------------------

NAME = ("CASE WHEN c_acctbal < 0 THEN 'SAINT-Denis ' || (c_custkey // 2) "
        "ELSE 'Île d''Évry ' || c_custkey END")

RAW_WEATHER = f"""raw_weather AS (
  SELECT CASE WHEN o_totalprice >= 1500 THEN o_orderdate END AS time,
    CASE o_orderstatus WHEN 'F' THEN CAST(c_custkey AS VARCHAR) WHEN 'O' THEN {NAME} END AS nom_poi,
    CASE WHEN o_orderstatus = 'F' THEN 'ÎLE D’ÉVRY ' || (c_custkey + 1)
         WHEN o_orderpriority <> '5-LOW' THEN {NAME} END AS ville,
    c_acctbal / 200 AS latitude_poi, c_acctbal / 100 AS longitude_poi,
    CAST(c_nationkey AS VARCHAR) AS numero_departement,
    CAST(o_orderkey % 100 AS DOUBLE) AS weather_code,
    o_totalprice / 10000 - 10 AS temperature_2m_mean,
    o_totalprice / 10000 - 15 AS temperature_2m_min,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice / 10000 - 5 END
      AS temperature_2m_max,
    o_totalprice / 10000 - 11 AS apparent_temperature_mean,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice / 10000 - 4 END
      AS apparent_temperature_max,
    CAST((o_orderkey * 7) % 101 AS DOUBLE) AS relative_humidity_2m_mean,
    ((o_orderkey * 3) % 211) / 8 AS precipitation_sum,
    ((o_orderkey * 5) % 223) / 8 AS rain_sum,
    ((o_custkey * 11) % 401) / 16 AS wind_speed_10m_mean,
    ((o_custkey * 13) % 809) / 16 AS wind_speed_10m_max,
    ((o_orderkey * 17) % 1201) / 16 AS wind_gusts_10m_max,
    980 + ((o_orderkey * 19) % 481) / 8 AS pressure_msl_mean,
    CAST((o_orderkey * 23) % 50021 AS DOUBLE) AS sunshine_duration,
    o_orderkey AS reading_id
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

RAW_COMMUNES = """raw_communes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS insee,
    CASE WHEN c_acctbal < 0 THEN '  Saint Denis ' || (c_custkey // 2)
         ELSE '  Ile-d Evry-' || c_custkey END || chr(9) AS commune,
    ' ' || n_name AS departement, r_name || ' ' AS region,
    CASE WHEN c_acctbal <= 9000 THEN CAST(c_nationkey AS VARCHAR) END AS numero_departement,
    CASE WHEN c_acctbal >= -950 THEN c_acctbal / 200 END AS latitude,
    c_acctbal / 100 AS longitude, CAST(c_acctbal AS VARCHAR) AS centroide,
    s.prefix || c_mktsegment AS service
  FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey,
    (VALUES ('SDIS '), ('SAMU ')) AS s(prefix))"""

LISTED = f"""listed AS (
  SELECT insee AS code, {trim('commune')} AS ville, {trim('departement')} AS departement,
    {trim('region')} AS region, numero_departement, latitude, longitude,
    {trim('centroide')} AS centroide, {trim('service')} AS service
  FROM raw_communes)"""

LISTED_ORDER = ("centroide NULLS LAST, departement NULLS LAST, latitude NULLS LAST, "
                "longitude NULLS LAST, numero_departement NULLS LAST, region NULLS LAST, "
                "service NULLS LAST, ville NULLS LAST")

COMMUNES = f"""communes AS (
  SELECT CASE WHEN regexp_matches(code, '^2[AB]') THEN code ELSE lpad(code, 5, '0') END
      AS code_insee, * EXCLUDE (code)
  FROM listed
  WHERE code IS NOT NULL AND ville <> '' AND latitude IS NOT NULL AND longitude IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY code_insee ORDER BY {LISTED_ORDER}) = 1)"""

RESOLVED = f"""keyed AS (
  SELECT *, {code_key('nom_poi')} AS k1, {point_key('nom_poi')} AS k2, {fold('ville')} AS k3
  FROM raw_weather WHERE time IS NOT NULL),
known AS (SELECT *, {fold('ville')} AS name_key FROM communes),
resolved AS (
  SELECT DISTINCT r.* EXCLUDE (ville, numero_departement),
    coalesce(a.code_insee, b.code_insee, c.code_insee) AS code_insee,
    coalesce(a.ville, b.ville, c.ville) AS ville,
    coalesce(a.numero_departement, b.numero_departement, c.numero_departement)
      AS numero_departement,
    coalesce(a.latitude, b.latitude, c.latitude) AS latitude,
    coalesce(a.longitude, b.longitude, c.longitude) AS longitude
  FROM keyed r LEFT JOIN communes a ON a.code_insee = r.k1
    LEFT JOIN known b ON b.name_key = r.k2
    LEFT JOIN known c ON c.name_key = r.k3
  WHERE coalesce(a.code_insee, b.code_insee, c.code_insee) IS NOT NULL)"""

MEASURES = {**schemas.MEASURES, **schemas.EXTRA_MEASURES}
RENAMED = ", ".join(f"{k} AS {v}" for k, v in {"weather_code": "code_meteo", **MEASURES}.items())
TIES = ", ".join(f"{c} NULLS LAST" for c in
                 ["code_meteo", *MEASURES.values(), "ville", "numero_departement", "latitude",
                  "longitude"])

STAGED = f"""renamed AS (
  SELECT CAST(time AS DATE) AS date, code_insee, ville, {RENAMED},
    numero_departement, latitude, longitude
  FROM resolved),
staged AS (
  SELECT * FROM renamed
  QUALIFY row_number() OVER (PARTITION BY date, code_insee ORDER BY
    CASE WHEN temperature_max IS NULL THEN 1 ELSE 0 END,
    CASE WHEN temperature_ressentie_max IS NULL THEN 1 ELSE 0 END, {TIES}) = 1)"""

ROUNDED = ", ".join(f"{rnd(c, 2)} AS {c}" for c in MEASURES.values())
FACT = f"""fact AS (SELECT * REPLACE ({ROUNDED}) FROM staged)"""

WIDE = """wide AS (
  SELECT f.* RENAME (temperature_min AS temperature_minimale,
                     temperature_max AS temperature_maximale,
                     ensoleillement_duree AS duree_ensoleillement), c.departement, c.region
  FROM fact f JOIN communes c USING (code_insee))"""

PLACED = ", ".join([RAW_WEATHER, RAW_COMMUNES, LISTED, COMMUNES, RESOLVED])
BUILT = ", ".join([PLACED, STAGED, FACT])

PANEL = """panel AS (
  SELECT CAST(o_orderdate AS DATE) AS date, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS code_insee,
    CASE WHEN c_acctbal >= -900 THEN c_name END AS ville,
    CASE WHEN c_acctbal <= 9900 THEN n_name END AS departement,
    CASE WHEN c_acctbal <= 9800 THEN r_name END AS region,
    CAST(c_nationkey AS VARCHAR) AS numero_departement,
    o_totalprice / 10000 - 10 AS temperature_moyenne,
    ((o_orderkey * 29) % 601) / 16 - 15 AS temperature_minimale,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_totalprice / 10000 - 5 END
      AS temperature_maximale,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST((o_orderkey * 7) % 103 AS DOUBLE) END
      AS humidite_moyenne,
    ((o_orderkey * 3) % 211) / 8 AS precipitations_totales,
    ((o_orderkey * 5) % 223) / 8 AS pluie_totale,
    ((o_custkey * 11) % 401) / 16 AS vitesse_vent_moyenne,
    ((o_custkey * 13) % 809) / 16 AS vitesse_vent_maximale,
    980 + ((o_orderkey * 19) % 481) / 8 AS pression_moyenne,
    CAST((o_orderkey * 23) % 50021 AS DOUBLE) AS duree_ensoleillement,
    CASE WHEN o_orderstatus = 'P' THEN o_custkey % 7 END AS deces,
    CASE WHEN o_orderstatus <> 'F' THEN o_custkey % 11 END AS hospitalisations,
    o_totalprice > 400000 AS alerte
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

RAW_HEALTH = """raw_health AS (
  SELECT make_date(CAST(year(l_shipdate) AS INT), 1, 1) AS annee, n_name AS libgeo,
    CAST(s_nationkey AS VARCHAR) AS dep, CAST(n_regionkey AS VARCHAR) AS reg,
    r_name AS nom_region,
    nullif(CAST(count(DISTINCT CASE WHEN l_quantity > 45 THEN CAST(l_shipdate AS DATE) END)
                AS DOUBLE), 0) AS nb_j_can
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL)"""
HEALTH = f"""health AS (
  SELECT annee, libgeo AS departement_nom, dep AS departement_code, reg, nom_region,
    {plain('nom_region')} AS region_key, nb_j_can AS nb_jours_canicule
  FROM raw_health WHERE annee IS NOT NULL AND libgeo IS NOT NULL AND nb_j_can IS NOT NULL)"""

RAW_WINTER = """raw_winter AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS reg,
    'Région ' || l_linestatus AS nom_region, l_linestatus AS sous_chapitre,
    CAST(l_linenumber AS VARCHAR) AS theme, l_returnflag AS indicateur,
    CASE WHEN l_linenumber <> 7 THEN l_quantity END AS valeur
  FROM lineitem)"""

EVENTS = """readings AS (
  SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS code_insee,
    CASE WHEN event_type <> 'error' THEN value END AS temperature_max,
    CASE WHEN event_type <> 'click' THEN value + 1 END AS temperature_ressentie_max,
    event_type, event_id, ts FROM events)"""

# ---- scans, sources, sinks ----------------------------------------------------

STAMP = "strftime(time, '%Y-%m-%d %H:%M:%S')"

SQL["s1_weather_scan"] = f"""WITH {RAW_WEATHER}
SELECT reading_id, {STAMP} AS time, nom_poi, ville, temperature_2m_max
FROM raw_weather WHERE time IS NOT NULL"""

SQL["s2_commune_scan"] = f"WITH {RAW_COMMUNES}, {LISTED} SELECT * FROM listed"

SQL["s3_heat_health_scan"] = f"""WITH {RAW_HEALTH}
SELECT * REPLACE ({day('annee')} AS annee) FROM raw_health WHERE nb_j_can IS NOT NULL"""

SQL["s4_winter_scan"] = f"""WITH {RAW_WINTER}
SELECT * REPLACE ({day('date')} AS date) FROM raw_winter
WHERE date IS NOT NULL AND valeur IS NOT NULL"""

_ARRAYS = """cells AS (
  SELECT strftime(CAST(ts AS DATE) + i, '%Y-%m-%d 00:00:00') AS time,
    event_id || '-' || pos AS nom_poi, 'Ville ' || user_id AS ville,
    user_id / 10 AS latitude_poi, pos / 10 AS longitude_poi,
    CAST(pos AS VARCHAR) AS numero_departement,
    CAST(CASE WHEN pos = 0 AND i = 1 THEN user_id WHEN pos = 0 AND i = 2 THEN 3 END AS DOUBLE)
      AS weather_code,
    CASE WHEN pos = 0 AND i = 0 THEN value WHEN pos = 0 AND i = 2 THEN value + 1
         WHEN pos = 1 AND i = 0 THEN value + 3 END AS temperature_2m_mean,
    CASE WHEN pos = 0 AND i = 0 THEN value + 2 WHEN pos = 1 AND i = 2 THEN value + 4 END
      AS temperature_2m_max
  FROM events, (VALUES (0), (1)) AS p(pos), (VALUES (0), (1), (2)) AS d(i))"""
SQL["s5_daily_arrays"] = f"WITH {_ARRAYS} SELECT * FROM cells"
SQL["s6_daily_arrays_strict"] = (
    f"WITH {_ARRAYS} SELECT * FROM cells WHERE temperature_2m_mean IS NOT NULL")

SQL["s5_drifted_arrays"] = """
SELECT strftime(CAST(ts AS DATE) + i, '%Y-%m-%d 00:00:00') AS time, event_id || '-0' AS nom_poi,
  'Ville ' || user_id AS ville, user_id / 10 AS latitude_poi, 0 / 10 AS longitude_poi,
  '0' AS numero_departement, CAST(NULL AS DOUBLE) AS weather_code,
  CASE WHEN i = 0 THEN value END AS temperature_2m_mean,
  CAST(CASE WHEN i = 0 THEN user_id END AS DOUBLE) AS temperature_2m_max
FROM events, (VALUES (0), (1)) AS d(i) WHERE user_id % 4 <> 3"""
SQL["s5_other_variables"] = """
SELECT event_id AS batch_id, 0 AS pos, 'uv_index_max' AS variable, i,
  CASE WHEN i = 0 THEN user_id ELSE event_id END AS value
FROM events, (VALUES (0), (1)) AS d(i) WHERE user_id % 4 <> 3"""
SQL["s5_unreadable"] = "SELECT event_id AS batch_id FROM events WHERE user_id % 4 = 3"

_RECORD = """SELECT CAST(c_nationkey AS VARCHAR) AS {0}, c_name AS {1}, c_mktsegment AS {2},
  'Île ' || c_mktsegment AS {3}, CAST(2000 + i AS VARCHAR) AS {4}, c_acctbal + i AS {5}
FROM customer, (VALUES (0), (1)) AS n(i)"""
SQL["s8_pages_flatten"] = _RECORD.format("dep", "libgeo", "reg", "reglib", "annee", "nb_j_can")
SQL["s9_heat_record_map"] = _RECORD.format(
    "code_departement", "departement_nom", "region_code", "region_nom", "annee", "nombre_jours")

SQL["s10_tagged_union"] = """
SELECT c_custkey AS id, c_name AS libelle, c_acctbal AS valeur, 'Grippe' AS pathologie,
  CAST(NULL AS VARCHAR) AS marque FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'Bronchiolite', NULL FROM supplier
UNION ALL SELECT p_partkey, p_name, NULL, 'Gastro-enterite aigue', p_brand FROM part"""

_LOCATIONS = f"""locations AS (
  SELECT {collector('insee')} AS code_insee, commune AS ville, numero_departement, latitude,
    longitude
  FROM raw_communes WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  QUALIFY code_insee IS NOT NULL AND row_number() OVER (PARTITION BY code_insee ORDER BY
    ville NULLS LAST, numero_departement NULLS LAST, latitude, longitude) = 1)"""
SQL["s11_locations"] = f"WITH {RAW_COMMUNES}, {_LOCATIONS} SELECT * FROM locations"

SQL["s12_locations_backfill"] = f"""WITH {RAW_COMMUNES}
SELECT DISTINCT commune AS name, latitude AS lat, longitude AS lon,
  {padded('numero_departement', 2)} AS dept
FROM raw_communes WHERE commune IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"""


def _conformed() -> str:
    have = {"latitude_poi", "longitude_poi", "numero_departement", "nom_poi", "ville",
            "weather_code", "apparent_temperature_mean", *MEASURES}
    columns = []
    for f in schemas.RAW_WEATHER.fields:
        kind = {"double": "DOUBLE"}.get(f.dataType.simpleString(), "VARCHAR")
        if f.name == "time":
            columns.append(f"{STAMP} AS time")
        elif f.name == "row_hash":
            columns.append("CAST(reading_id AS VARCHAR) AS row_hash")
        elif f.name in have:
            columns.append(f.name)
        else:
            columns.append(f"CAST(NULL AS {kind}) AS {f.name}")
    return ", ".join(columns)


SQL["s13_schema_conform"] = f"WITH {RAW_WEATHER} SELECT {_conformed()} FROM raw_weather"

SQL["s17_inventory"] = " UNION ALL ".join(
    f"SELECT '{'reference' if t in ('region', 'nation') else 'donnees'}' AS dataset, "
    f"'{t}' AS \"table\", (SELECT count(*) FROM {t}) AS lignes, "
    f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS colonnes"
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split())

SQL["s19_incremental_delta"] = f"""WITH {PANEL}
SELECT {day('date')} AS date, code_insee, temperature_moyenne,
  {day("date_trunc('month', date)")} AS date_month
FROM panel p WHERE NOT EXISTS (
  SELECT 1 FROM panel s WHERE s.date < DATE '2001-01-01' AND s.date = p.date
    AND s.code_insee = p.code_insee)"""

# ---- projections and predicates ------------------------------------------------

SQL["p2_not_null_filter"] = f"""WITH {RAW_WEATHER}
SELECT reading_id, {STAMP} AS time, nom_poi, temperature_2m_max, apparent_temperature_max
FROM raw_weather
WHERE (time IS NULL OR nom_poi IS NULL OR temperature_2m_max IS NULL
       OR apparent_temperature_max IS NULL) = false"""

SQL["p3_blank_filter"] = f"""
SELECT * FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN ' ' || chr(9) || '  '
                                      ELSE c_name || ' ' END AS ville FROM customer)
WHERE length({trim('ville')}) > 0"""

SQL["p5_key_kinds"] = f"""WITH {RAW_WEATHER}
SELECT reading_id, {code_key('nom_poi')} AS key_code, {point_key('nom_poi')} AS key_point,
  {fold('ville')} AS key_town FROM raw_weather"""

SQL["p8_casts"] = f"""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS numero,
  {day('o_orderdate')} AS date, o_totalprice AS valeur, CAST(o_custkey AS DOUBLE) AS latitude
FROM orders"""

SQL["p11_ranges"] = f"""WITH {PANEL}
SELECT {day('date')} AS date, code_insee, temperature_moyenne FROM panel
WHERE date >= DATE '1995-06-01' AND date <= DATE '2000-12-31'
  AND month(date) IN (6, 7, 8, 9) AND year(date) >= 1996 AND year(date) <= 2000"""

SQL["p12_lookback"] = f"""WITH {EVENTS}
SELECT event_id, {day('date')} AS date, code_insee FROM readings
WHERE date >= DATE '2024-01-31' - INTERVAL 10 DAY"""

SQL["p13_window_missing"] = f"""WITH {RAW_WEATHER}, {RAW_COMMUNES}, {_LOCATIONS},
expected AS (
  SELECT CAST(d.day AS DATE) AS date, code_insee FROM locations,
    generate_series(DATE '2001-07-22', DATE '2001-08-01', INTERVAL 1 DAY) AS d(day))
SELECT {day('date')} AS date, code_insee FROM (
  SELECT * FROM expected EXCEPT
  SELECT CAST(time AS DATE), CASE WHEN regexp_matches(nom_poi, '^[0-9]+$')
                                  THEN lpad(nom_poi, 5, '0') ELSE nom_poi END FROM raw_weather)"""

SQL["p16_name_fallback"] = f"""WITH {RAW_WEATHER}
SELECT reading_id, {trim('ifnull(ville, nom_poi)')} AS nom FROM raw_weather"""

SQL["p17_fill_zero"] = f"""WITH {PANEL}
SELECT {day('date')} AS date, code_insee, CAST(ifnull(deces, 0) AS BIGINT) AS deces,
  CAST(ifnull(hospitalisations, 0) AS BIGINT) AS hospitalisations FROM panel"""

SQL["p18_dept_pad"] = f"""
SELECT c_custkey, {padded('CAST(c_nationkey AS VARCHAR)', 2)} AS dept,
  {padded('CAST(c_custkey AS VARCHAR)', 2)} AS long_code FROM customer"""

# ---- joins ----------------------------------------------------------------------

SQL["j1_place_resolution"] = f"""WITH {PLACED}
SELECT reading_id, temperature_2m_max, code_insee, ville, numero_departement, latitude, longitude
FROM resolved"""

_ANNUAL = f"""annual AS (
  SELECT year(date) AS annee, departement,
    {rnd('avg(temperature_moyenne)', 2)} AS temp_moyenne_annuelle,
    {rnd('max(temperature_maximale)', 1)} AS temp_max_absolue,
    count(*) FILTER (temperature_maximale > 35) AS jours_sup_35,
    count(*) FILTER (temperature_maximale > 30) AS jours_sup_30,
    {rnd('avg(humidite_moyenne)', 1)} AS humidite_moyenne,
    {rnd('sum(precipitations_totales)', 1)} AS precipitations_annuelles
  FROM panel GROUP BY 1, 2)"""
_SUMMER = f"""summer AS (
  SELECT year(date) AS annee, departement,
    {rnd('avg(temperature_moyenne)', 2)} AS temp_moyenne_ete,
    {rnd('avg(temperature_maximale)', 2)} AS temp_max_moyenne_ete
  FROM panel WHERE month(date) IN (6, 7, 8, 9) GROUP BY 1, 2)"""

SQL["j2_annual_summer"] = f"""WITH {PANEL}, {_ANNUAL}, {_SUMMER}
SELECT * FROM annual JOIN summer USING (annee, departement)"""

SQL["j3_weather_health"] = f"""WITH {PANEL}, {RAW_HEALTH}, {HEALTH}, {_ANNUAL}
SELECT a.*, h.nb_jours_canicule FROM annual a JOIN health h
  ON CAST(a.annee AS VARCHAR) = strftime(h.annee, '%Y') AND a.departement = h.departement_nom"""

SQL["j4_key_coverage"] = f"""WITH {PANEL}, {RAW_HEALTH},
ours AS (SELECT DISTINCT departement AS k FROM panel),
theirs AS (SELECT DISTINCT libgeo AS k FROM raw_health)
SELECT (SELECT count(*) FROM ours) AS nb_gauche, (SELECT count(*) FROM theirs) AS nb_droite,
  (SELECT count(*) FROM ours SEMI JOIN theirs USING (k)) AS nb_correspondances"""

SQL["j5_key_gaps"] = """WITH
ours AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS nom FROM events),
theirs AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS nom FROM supplier)
SELECT 'meteo seulement' AS source, nom FROM ours WHERE nom NOT IN (FROM theirs)
UNION ALL
SELECT 'odisse seulement' AS source, nom FROM theirs WHERE nom NOT IN (FROM ours)"""

_BATCH = """batch AS (
  SELECT ts AS time, lpad(CAST(user_id AS VARCHAR), 5, '0') AS nom_poi, event_id, value,
    CAST(ts AS DATE) AS date FROM events),
stored AS (
  SELECT DISTINCT CAST(ts AS DATE) AS date, lpad(CAST(user_id AS VARCHAR), 5, '0') AS nom_poi
  FROM events WHERE ts < TIMESTAMP '2024-01-16'
    AND ts >= DATE '2024-01-31' - INTERVAL 60 DAY)"""
SQL["j6_append_new_keys"] = f"""WITH {_BATCH}
SELECT {STAMP} AS time, nom_poi, event_id, value FROM batch ANTI JOIN stored USING (date, nom_poi)
QUALIFY row_number() OVER (PARTITION BY date, nom_poi ORDER BY event_id) = 1"""

SQL["j7_append_new_hash"] = f"""WITH named AS (
  SELECT ts AS time, 'Ville ' || user_id AS nom_poi, event_id,
    sha256(strftime(ts, '%Y-%m-%d') || ' 00:00:00_Ville ' || user_id) AS row_hash FROM events)
SELECT {STAMP} AS time, nom_poi, event_id, row_hash FROM named
WHERE row_hash NOT IN (SELECT row_hash FROM named WHERE time < TIMESTAMP '2024-01-16')"""

SQL["j8_append_record_key"] = f"""WITH records AS (
  SELECT CAST(user_id AS VARCHAR) AS code_departement, CAST(ts AS DATE) AS annee, event_id,
    value AS nombre_jours FROM events)
SELECT * REPLACE ({day('annee')} AS annee) FROM records r
WHERE NOT EXISTS (SELECT 1 FROM records s WHERE s.annee < DATE '2024-01-16'
                    AND s.annee = r.annee AND s.code_departement = r.code_departement)
QUALIFY row_number() OVER (PARTITION BY r.code_departement, r.annee
                           ORDER BY event_id NULLS LAST) = 1"""

SQL["j9_record_hash_dedup"] = """
SELECT sha256(text) AS text_sha, lang, source FROM (SELECT DISTINCT text, lang, source
                                                    FROM documents)"""

# ---- aggregates -----------------------------------------------------------------

SQL["a1_coverage"] = f"""WITH {PANEL}
SELECT count(*) AS total_lignes, count(DISTINCT ville) AS nb_communes,
  count(DISTINCT code_insee) AS nb_codes_insee, count(DISTINCT departement) AS nb_departements,
  count(DISTINCT region) AS nb_regions, {day('min(date)')} AS date_min,
  {day('max(date)')} AS date_max, count(DISTINCT date) AS nb_jours FROM panel"""


def _profile(source: str, columns: list[str]) -> str:
    share = rnd("(count(*) - count({0})) * 100.0 / count(*)", 3)
    return " UNION ALL ".join(
        f"SELECT '{c}' AS colonne, count(*) - count({c}) AS nb_nulls, {share.format(c)} AS taux "
        f"FROM {source}" for c in columns)


SQL["a2_null_profile"] = f"WITH {PANEL} " + _profile("panel", [
    "date", "ville", "code_insee", "departement", "region", "temperature_moyenne",
    "humidite_moyenne", "vitesse_vent_moyenne", "pression_moyenne"])
SQL["a3_null_profile_raw"] = f"WITH {RAW_WEATHER} " + _profile(
    "raw_weather", ["nom_poi", "latitude_poi", "temperature_2m_mean"])

SQL["a4_bounds"] = f"""WITH {PANEL} SELECT """ + ", ".join(
    f"{rnd(expr, 1)} AS {name}" for name, expr in {
        "temp_min_absolue": "min(temperature_minimale)",
        "temp_max_absolue": "max(temperature_maximale)",
        "humidite_min": "min(humidite_moyenne)", "humidite_max": "max(humidite_moyenne)",
        "precip_min": "min(precipitations_totales)", "precip_max": "max(precipitations_totales)",
        "vent_max": "max(vitesse_vent_maximale)", "pression_min": "min(pression_moyenne)",
        "pression_max": "max(pression_moyenne)"}.items()) + " FROM panel"

_RULES = {
    "min_superieur_max": "temperature_minimale > temperature_maximale",
    "moyenne_sous_min": "temperature_moyenne < temperature_minimale",
    "moyenne_sur_max": "temperature_moyenne > temperature_maximale",
    "humidite_hors_bornes": "humidite_moyenne < 0 OR humidite_moyenne > 100",
    "precipitations_negatives": "precipitations_totales < 0",
    "pluie_superieure_precip": "pluie_totale > precipitations_totales"}
SQL["a5_coherence"] = f"WITH {PANEL} " + " UNION ALL ".join(
    f"SELECT '{n}' AS regle, count(*) AS nb_anomalies, "
    f"CASE count(*) WHEN 0 THEN 'OK' ELSE 'A CORRIGER' END AS statut FROM panel WHERE {rule}"
    for n, rule in _RULES.items())

SQL["a6_key_uniqueness"] = f"""WITH {PANEL}
SELECT count(*) AS total_lignes, count(DISTINCT {day('date')} || '|' || ville) AS couples_uniques,
  total_lignes - couples_uniques AS doublons FROM panel"""

SQL["a7_continuity"] = f"""WITH {PANEL}
SELECT {day('min(date)')} AS date_min, {day('max(date)')} AS date_max,
  count(DISTINCT date) AS jours_presents, date_diff('day', min(date), max(date)) + 1
    AS jours_attendus, jours_attendus - jours_presents AS jours_manquants FROM panel"""

SQL["a8_incomplete_days"] = f"""WITH {PANEL}
SELECT {day('date')} AS jour, count(DISTINCT ville) AS nb_communes FROM panel
GROUP BY 1 HAVING nb_communes < 6"""

SQL["a9_name_variants"] = """
SELECT CAST(user_id AS VARCHAR) AS code_insee, count(*) AS nb_variantes,
  string_agg(event_type, ' | ' ORDER BY event_type) AS orthographes
FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1 HAVING count(*) > 1"""

_LOADS = "lineitem JOIN orders ON l_orderkey = o_orderkey"
SQL["a10_insert_trace"] = f"""
SELECT {day('l_shipdate')} AS jour_insertion, count(*) AS lignes_inserees,
  {day('max(o_orderdate)')} AS donnee_la_plus_recente FROM {_LOADS} GROUP BY 1"""

SQL["a11_dept_years"] = f"""WITH {RAW_HEALTH}, {HEALTH}
SELECT departement_nom, departement_code, count(*) AS nb_annees FROM health
GROUP BY ALL ORDER BY departement_nom, departement_code LIMIT 10"""

SQL["a12_seasonality"] = f"""WITH {PANEL}
SELECT month(date) AS mois, {six('avg(temperature_moyenne)')} AS temp_moy,
  {six('avg(temperature_maximale)')} AS temp_max,
  {six('avg(temperature_minimale)')} AS temp_min FROM panel GROUP BY 1"""

_YEARLY = f"""yearly AS (
  SELECT year(date) AS annee, {rnd('avg(temperature_moyenne)', 2)} AS temp_moyenne_annuelle,
    {rnd('avg(temperature_maximale)', 2)} AS temp_max_moyenne,
    {rnd('max(temperature_maximale)', 1)} AS temp_max_absolue FROM panel GROUP BY 1)"""
SQL["a13_yearly_trend"] = f"WITH {PANEL}, {_YEARLY} SELECT * FROM yearly"

_CLIMATE = f"""climate AS (
  SELECT departement, region, {rnd('avg(temperature_moyenne)', 2)} AS temp_moyenne,
    {rnd('max(temperature_maximale)', 1)} AS temp_max_absolue,
    {rnd('avg(humidite_moyenne)', 1)} AS humidite_moyenne,
    count(DISTINCT ville) AS nb_communes
  FROM panel WHERE year(date) BETWEEN 1995 AND 2001 GROUP BY 1, 2)"""
SQL["a14_department_climate"] = f"WITH {PANEL}, {_CLIMATE} SELECT * FROM climate"
SQL["a15_region_climate"] = f"""WITH {PANEL}, {_CLIMATE}
SELECT region, {six('avg(temp_moyenne)')} AS temp_moyenne, max(temp_max_absolue) AS temp_max,
  count(departement) AS nb_depts FROM climate WHERE region IS NOT NULL GROUP BY region"""

SQL["a16_heat_days_year"] = f"""WITH {BUILT}, {WIDE}
SELECT year(date) AS annee, count(*) FILTER (temperature_maximale > 30) AS jours_sup_30,
  count(*) FILTER (temperature_maximale > 35) AS jours_sup_35,
  count(*) FILTER (temperature_maximale > 40) AS jours_sup_40,
  count(DISTINCT departement) FILTER (temperature_maximale > 35) AS depts_touches_35
FROM wide GROUP BY 1"""

SQL["a17_heat_days_month"] = f"""WITH {PANEL}
SELECT month(date) AS mois, count(*) FILTER (temperature_maximale > 35) AS jours_sup_35
FROM panel GROUP BY 1"""

SQL["a18_dept_year"] = f"WITH {PANEL}, {_ANNUAL} SELECT * FROM annual"
SQL["a19_dept_summer"] = f"WITH {PANEL}, {_SUMMER} SELECT * FROM summer"

_CROSSED = f"""{PANEL}, {RAW_HEALTH}, {HEALTH}, {_ANNUAL}, {_SUMMER},
crossed AS (
  SELECT a.*, s.temp_moyenne_ete, s.temp_max_moyenne_ete, h.nb_jours_canicule
  FROM health h JOIN annual a ON a.annee = year(h.annee) AND a.departement = h.departement_nom
    JOIN summer s ON s.annee = a.annee AND s.departement = a.departement)"""
SQL["a20_weather_health"] = f"WITH {_CROSSED} SELECT * FROM crossed"


def _corr(x: str, y: str) -> str:
    return f"CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE {six(f'corr({x}, {y})')} END"


CORRELATED = ["temperature_moyenne", "temperature_maximale", "temperature_minimale",
              "humidite_moyenne", "precipitations_totales", "vitesse_vent_moyenne",
              "pression_moyenne", "duree_ensoleillement"]
SQL["a21_corr_matrix"] = f"WITH {PANEL} " + " UNION ALL ".join(
    f"SELECT '{x}' AS variable_1, '{y}' AS variable_2, {_corr(x, y)} AS r FROM panel"
    for x in CORRELATED for y in CORRELATED)
SQL["a22_corr_health"] = f"""WITH {_CROSSED}
SELECT {_corr('temp_max_moyenne_ete', 'nb_jours_canicule')} AS r_temp_ete,
  {_corr('jours_sup_35', 'nb_jours_canicule')} AS r_jours_35 FROM crossed"""


def _summary(column: str, label: str) -> str:
    figures = {"mean": f"avg({column})", "std": f"stddev_samp({column})", "min": f"min({column})",
               "p25": f"quantile_cont({column}, 0.25)", "p50": f"quantile_cont({column}, 0.5)",
               "p75": f"quantile_cont({column}, 0.75)", "max": f"max({column})"}
    return (f"SELECT '{label}' AS variable, count({column}) AS count, "
            + ", ".join(f"{rnd(e, 2)} AS {n}" for n, e in figures.items()) + " FROM panel")


SQL["a23_describe"] = f"WITH {PANEL} " + " UNION ALL ".join(
    [_summary(c, c) for c in CORRELATED]
    + [_summary("CAST(year(date) AS DOUBLE)", "annee"),
       _summary("CAST(month(date) AS DOUBLE)", "mois")])

_DRAWN = ["temperature_moyenne", "temperature_maximale", "humidite_moyenne",
          "vitesse_vent_moyenne", "pression_moyenne", "duree_ensoleillement"]
SQL["a24_histogram"] = f"""WITH {PANEL},
melted AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS v FROM panel WHERE {c} IS NOT NULL" for c in _DRAWN) + f"""),
ends AS (SELECT variable, min(v) AS lo, max(v) AS hi FROM melted GROUP BY 1),
placed AS (SELECT variable, least(CAST(floor(60 * (v - lo) / (hi - lo)) AS BIGINT) + 1, 60) AS bin,
  count(*) AS n FROM melted JOIN ends USING (variable) GROUP BY 1, 2)
SELECT variable, b.bin, {six('lo + (hi - lo) / 60 * (b.bin - 1)')} AS lower,
  {six('lo + (hi - lo) / 60 * b.bin')} AS upper, ifnull(n, 0) AS n
FROM ends CROSS JOIN range(1, 61) AS b(bin) LEFT JOIN placed USING (variable, bin)"""

SQL["a25_linear_trend"] = f"""WITH {PANEL}, {_YEARLY}
SELECT {six('regr_slope(temp_moyenne_annuelle, annee)')} AS pente,
  {six('regr_intercept(temp_moyenne_annuelle, annee)')} AS ordonnee,
  {six('regr_slope(temp_moyenne_annuelle, annee) * 10')} AS par_decennie
FROM yearly WHERE annee < 2001"""

SQL["a26_batch_gate"] = f"""WITH {RAW_WEATHER}
SELECT count(*) AS total, count(*) - count(temperature_2m_max) AS missing,
  {six('100.0 * (count(*) - count(temperature_2m_max)) / count(*)')} AS missing_pct,
  CASE WHEN missing * 2 > total THEN 'refused' WHEN missing > 0 THEN 'warning'
       ELSE 'accepted' END AS verdict FROM raw_weather"""

SQL["a27_ingest_counts"] = f"""WITH {_BATCH}
SELECT count(*) AS received, count(DISTINCT CASE WHEN s.date IS NULL
    THEN {day('b.date')} || b.nom_poi END) AS inserted, received - inserted AS skipped
FROM batch b LEFT JOIN stored s ON s.date = b.date AND s.nom_poi = b.nom_poi"""

SQL["a29_step_totals"] = f"""
SELECT CASE WHEN grouping(event_type) = 1 THEN 'TOTAL' ELSE event_type END AS step,
  {six('sum(value / 1000)')} AS co2_kg, {six('sum(value)')} AS time_s
FROM events GROUP BY ROLLUP (event_type)"""

SQL["a30_run_history"] = f"""
SELECT {day('l_shipdate')} AS execution_date, count(*) AS rows_inserted,
  {day('min(o_orderdate)')} AS min_date, {day('max(o_orderdate)')} AS max_date,
  count(DISTINCT o_custkey) AS communes FROM {_LOADS}
GROUP BY 1 ORDER BY 1 DESC LIMIT 30"""

SQL["a31_day_coverage"] = f"""WITH {PANEL}
SELECT count(DISTINCT code_insee) AS communes FROM panel
WHERE date = DATE '2001-08-06' - INTERVAL 5 DAY"""

SQL["a32_fact_size"] = f"""WITH {PANEL}
SELECT count(*) AS lignes, count(DISTINCT date) AS jours FROM panel"""

SQL["a33_period_region"] = f"""WITH {PANEL}
SELECT strftime(date, '%Y%m') AS period_key, region,
  CAST(sum(ifnull(deces, 0)) AS BIGINT) AS total_deaths,
  CAST(sum(ifnull(hospitalisations, 0)) AS BIGINT) AS total_hospitalizations,
  {rnd('avg(temperature_moyenne)', 2)} AS avg_temperature,
  max(temperature_maximale) AS max_temperature,
  count(DISTINCT date) FILTER (alerte) AS alert_days FROM panel GROUP BY 1, 2"""

SQL["a34_volume_log"] = f"""
SELECT {day('ts')} AS day, count(*) AS rows_processed,
  {six('sum(value * 1e8) / (1024 * 1024 * 1024)')} AS gb_billed
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - INTERVAL 7 DAY GROUP BY 1"""

# ---- windows and top-k ----------------------------------------------------------

SQL["w1_commune_dedup"] = f"""WITH {RAW_COMMUNES}, {LISTED}
SELECT * FROM listed
QUALIFY row_number() OVER (PARTITION BY code ORDER BY {LISTED_ORDER}) = 1"""

SQL["w2_weather_dedup"] = f"""WITH {EVENTS}
SELECT * EXCLUDE (ts) REPLACE ({day('date')} AS date) FROM readings
QUALIFY row_number() OVER (PARTITION BY readings.date, code_insee ORDER BY
  CASE WHEN temperature_max IS NOT NULL THEN 0 ELSE 1 END,
  CASE WHEN temperature_ressentie_max IS NOT NULL THEN 0 ELSE 1 END, event_id) = 1"""

SQL["w3_latest_wins"] = f"""WITH {EVENTS}
SELECT * EXCLUDE (ts) REPLACE ({day('date')} AS date) FROM readings
QUALIFY row_number() OVER (PARTITION BY readings.date, code_insee
                           ORDER BY ts DESC, event_id) = 1"""

SQL["w4_heatwave_3day"] = f"""WITH {PANEL},
daily AS (
  SELECT departement, date, avg(temperature_minimale) AS low, avg(temperature_maximale) AS high
  FROM panel WHERE departement IS NOT NULL GROUP BY 1, 2),
runs AS (
  SELECT a.departement, a.date, (a.low + b.low + c.low) / 3 AS moyenne_min,
    (a.high + b.high + c.high) / 3 AS moyenne_max
  FROM daily a JOIN daily b ON b.departement = a.departement AND b.date = a.date - 1
    JOIN daily c ON c.departement = a.departement AND c.date = a.date - 2)
SELECT departement, {day('date')} AS date, {six('moyenne_min')} AS moyenne_min,
  {six('moyenne_max')} AS moyenne_max, n_nationkey / 10 - 2 AS seuil_min,
  n_nationkey / 10 + 15 AS seuil_max
FROM runs JOIN nation ON n_name = departement
WHERE moyenne_min > n_nationkey / 10 - 2 AND moyenne_max > n_nationkey / 10 + 15"""

SQL["o4_top_bottom"] = f"""WITH {PANEL}, {_CLIMATE}
(SELECT 'chaud' AS cote, departement, region, temp_moyenne FROM climate
 WHERE temp_moyenne IS NOT NULL
 ORDER BY temp_moyenne DESC, departement NULLS LAST, region NULLS LAST LIMIT 15)
UNION ALL
(SELECT 'frais', departement, region, temp_moyenne FROM climate WHERE temp_moyenne IS NOT NULL
 ORDER BY temp_moyenne, departement NULLS LAST, region NULLS LAST LIMIT 15)"""

# ---- scalar functions -----------------------------------------------------------

SQL["f1_fold_name"] = f"""
SELECT doc_id, sha256({fold("replace(text, 'ß', 'ss')")}) AS folded FROM documents"""
SQL["f2_region_key"] = f"""
SELECT doc_id, sha256({plain("replace(text, 'ß', 'ss')")}) AS region_key FROM documents"""

_CODES = """codes AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey * 37 AS VARCHAR)
    WHEN 'O' THEN ' ' || o_custkey || chr(9)
    ELSE CASE WHEN o_custkey % 2 = 0 THEN '2A' ELSE '2b' END
         || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') END AS code FROM orders)"""
SQL["f3_code_staging"] = f"""WITH {_CODES}
SELECT o_orderkey, CASE WHEN code[1:2] IN ('2A', '2B') THEN code ELSE lpad(code, 5, '0') END
  AS code FROM codes"""
SQL["f4_code_collector"] = f"""WITH {_CODES}
SELECT o_orderkey, {collector('code')} AS code FROM codes"""
SQL["f18_row_hash"] = """
SELECT event_id, sha256(strftime(ts, '%Y-%m-%d') || ' 00:00:00_' || user_id) AS row_hash
FROM events"""

# ---- data-quality checks ---------------------------------------------------------


def _check(model: str, source: str, column: str, check: str, violations: str) -> str:
    return (f"SELECT '{model}' AS model, '{column}' AS \"column\", '{check}' AS \"check\", "
            f"{violations} AS violations, "
            f"CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM {source}")


def _nulls(model: str, source: str, columns: list[str]) -> list[str]:
    return [_check(model, source, c, "not_null", f"count(*) - count({c})") for c in columns]


SQL["q1_not_null"] = f"""WITH {RAW_WEATHER}, {RAW_COMMUNES}, {LISTED}, {COMMUNES}, {RAW_HEALTH},
{HEALTH}, {PANEL}, days AS (SELECT DISTINCT CAST(time AS DATE) AS date, year(time) AS annee,
  month(time) AS mois FROM raw_weather WHERE time IS NOT NULL) """ + " UNION ALL ".join(
    _nulls("stg_communes", "communes", ["code_insee", "ville", "latitude", "longitude"])
    + _nulls("dim_commune", "communes", ["code_insee", "ville"])
    + _nulls("dim_date", "days", ["date", "annee", "mois"])
    + _nulls("stg_heat_health", "health", ["annee"])
    + _nulls("panel", "panel", ["date", "code_insee", "ville", "departement",
                                "temperature_maximale"]))

SQL["q2_unique"] = f"""WITH {RAW_COMMUNES}
SELECT insee AS code, count(*) AS n FROM raw_communes GROUP BY 1 HAVING n > 1"""

SQL["q3_unique_composite"] = f"""WITH {EVENTS}
SELECT {day('date')} AS date, code_insee, count(*) AS n FROM readings
GROUP BY ALL HAVING count(*) > 1"""

SQL["q4_range"] = f"WITH {PANEL} " + " UNION ALL ".join(
    _check("panel", "panel", c, "range", f"count(*) FILTER ({rule})") for c, rule in {
        "temperature_moyenne": "temperature_moyenne NOT BETWEEN -30 AND 45",
        "humidite_moyenne": "humidite_moyenne NOT BETWEEN 0 AND 100",
        "precipitations_totales": "precipitations_totales < 0",
        "temperature_maximale": "temperature_maximale NOT BETWEEN 0 AND 40"}.items())

SQL["q5_relationship"] = f"""WITH {RAW_COMMUNES}, {LISTED}, {COMMUNES}
SELECT code_insee, count(*) AS n
FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS code_insee FROM orders)
WHERE code_insee NOT IN (SELECT code_insee FROM communes) GROUP BY 1"""

SQL["q6_coverage"] = f"""WITH {PANEL}
SELECT count(DISTINCT departement) AS n FROM panel HAVING n <= 350"""

SQL["q7_sentinels"] = f"""WITH {PANEL}
SELECT 'pression_moyenne' AS colonne, count(*) FILTER (alerte) AS nb_sentinelles FROM panel
UNION ALL SELECT 'humidite_moyenne', count(*) FILTER (humidite_moyenne IN (-999, -9999))
FROM panel"""

SQL["q_declared_checks"] = f"WITH {BUILT} " + " UNION ALL ".join(
    _nulls("fct_daily", "fact", ["code_insee", "date", "temperature_max"])
    + [_check("fct_daily", "fact", c, "range", f"count(*) FILTER ({rule})") for c, rule in {
        "temperature_moyenne": "temperature_moyenne NOT BETWEEN -30 AND 45",
        "humidite_moyenne": "humidite_moyenne NOT BETWEEN 0 AND 100",
        "precipitations_totales": "precipitations_totales < 0"}.items()]
    + [_check("fct_daily", "fact", "pression_moyenne", "sentinel",
              "count(*) FILTER (pression_moyenne IN (-999, -9999))"),
       _check("fct_daily", "fact", "code_insee", "coverage",
              "CAST(count(DISTINCT code_insee) <= 350 AS BIGINT)"),
       _check("fct_daily", "(SELECT date, code_insee FROM fact GROUP BY ALL HAVING count(*) > 1)",
              "date, code_insee", "unique", "count(*)")])

SQL["q_checked_write"] = SQL["q_declared_checks"]
SQL["q_quarantine"] = f"""WITH {BUILT}, told AS (SELECT *, concat_ws(', ',
  CASE WHEN code_insee IS NULL THEN 'code_insee not_null' END,
  CASE WHEN date IS NULL THEN 'date not_null' END,
  CASE WHEN temperature_max IS NULL THEN 'temperature_max not_null' END,
  CASE WHEN temperature_moyenne NOT BETWEEN -30 AND 45 THEN 'temperature_moyenne range' END,
  CASE WHEN humidite_moyenne NOT BETWEEN 0 AND 100 THEN 'humidite_moyenne range' END,
  CASE WHEN precipitations_totales < 0 THEN 'precipitations_totales range' END,
  CASE WHEN pression_moyenne IN (-999, -9999) THEN 'pression_moyenne sentinel' END) AS reasons FROM fact)
SELECT {day('date')} AS date, code_insee, temperature_max, reasons FROM told WHERE reasons <> ''"""

# ---- models ----------------------------------------------------------------------

SQL["m_stg_communes"] = f"WITH {RAW_COMMUNES}, {LISTED}, {COMMUNES} SELECT * FROM communes"
SQL["m_stg_weather"] = f"""WITH {PLACED}, {STAGED}
SELECT * REPLACE ({day('date')} AS date) FROM staged"""
SQL["m_stg_heat_health"] = f"""WITH {RAW_HEALTH}, {HEALTH}
SELECT * REPLACE ({day('annee')} AS annee) FROM health"""
SQL["m_stg_winter"] = f"""WITH {RAW_WINTER}
SELECT {day('date')} AS date, reg, nom_region, {plain('nom_region')} AS region_key, sous_chapitre,
  theme, indicateur, valeur FROM raw_winter WHERE date IS NOT NULL AND valeur IS NOT NULL"""
SQL["m_dim_commune"] = f"""WITH {RAW_COMMUNES}, {LISTED}, {COMMUNES}
SELECT code_insee, ville, numero_departement, latitude, longitude FROM communes"""
SQL["m_dim_region"] = f"""WITH {RAW_COMMUNES}, {LISTED}, {COMMUNES}
SELECT DISTINCT region AS nom_region, {plain('region')} AS region_key FROM communes
WHERE region IS NOT NULL"""
SQL["m_dim_date"] = f"""WITH {RAW_WEATHER},
days AS (SELECT DISTINCT CAST(time AS DATE) AS date FROM raw_weather WHERE time IS NOT NULL)
SELECT {day('date')} AS date, year(date) AS annee, month(date) AS mois,
  ['Janv.', 'Févr.', 'Mars', 'Avr.', 'Mai', 'Juin', 'Juil.', 'Août', 'Sept.', 'Oct.', 'Nov.',
   'Déc.'][month(date)] AS nom_mois,
  {day("date_trunc('month', date)")} AS debut_mois, dayofweek(date) + 1 AS jour_semaine,
  dayofweek(date) IN (0, 6) AS est_weekend FROM days"""
SQL["m_fct_daily"] = f"WITH {BUILT} SELECT * REPLACE ({day('date')} AS date) FROM fact"
SQL["s19_incremental_fact"] = SQL["m_fct_daily"]
SQL["m_wide"] = f"WITH {BUILT}, {WIDE} SELECT * REPLACE ({day('date')} AS date) FROM wide"

# ---- streams ----------------------------------------------------------------------

SQL["t1_stream_first"] = f"""
SELECT DISTINCT {day('ts')} AS date, CAST(user_id AS VARCHAR) AS nom_poi FROM events"""
SQL["t2_stream_append"] = f"""WITH first AS (
  SELECT CAST(ts AS DATE) AS date, value FROM events
  QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY event_id) = 1)
SELECT {day("date_trunc('month', date)")} AS date_month,
  count(*) FILTER (value > 30) AS jours_sup_30, count(*) FILTER (value > 35) AS jours_sup_35,
  count(*) FILTER (value > 40) AS jours_sup_40 FROM first GROUP BY 1"""

# ---- late readings, states and best readings ------------------------------------------

SQL["s19_late_fact"] = SQL["m_fct_daily"]
SQL["s19_state_heat_days"] = SQL["a16_heat_days_year"]
SQL["s19_late_department_years"] = f"""WITH {BUILT}, {WIDE}, panel AS (SELECT * FROM wide), {_ANNUAL}, {_SUMMER}
SELECT a.*, s.temp_moyenne_ete, s.temp_max_moyenne_ete
FROM annual a LEFT JOIN summer s ON s.annee = a.annee AND s.departement = a.departement"""
SQL["t1_stream_best"] = SQL["w2_weather_dedup"]
SQL["t2_stream_best_report"] = f"""WITH {EVENTS},
best AS (
  SELECT * FROM readings
  QUALIFY row_number() OVER (PARTITION BY readings.date, code_insee ORDER BY
    temperature_max IS NULL, temperature_ressentie_max IS NULL, event_id) = 1)
SELECT {day("date_trunc('month', date)")} AS date_month, count(*) AS lignes,
  count(*) FILTER (temperature_max > 30) AS jours_sup_30, count(*) FILTER (temperature_max > 35) AS jours_sup_35,
  count(*) FILTER (temperature_max > 40) AS jours_sup_40 FROM best GROUP BY 1"""
for _name in ("a1_coverage", "a6_key_uniqueness", "a7_continuity", "a8_incomplete_days"):
    SQL[f"{_name}_bitmaps"] = SQL[_name]
SQL["s19_late_coverage"] = f"""WITH {BUILT}, {WIDE}
SELECT count(*) AS total_lignes, count(DISTINCT ville) AS nb_communes,
  count(DISTINCT code_insee) AS nb_codes_insee, count(DISTINCT departement) AS nb_departements,
  count(DISTINCT region) AS nb_regions, {day('min(date)')} AS date_min,
  {day('max(date)')} AS date_max, count(DISTINCT date) AS nb_jours FROM wide"""

# ---- health by code or name, appended lines, run logs ------------------------------------

SQL["j10_health_enrichment"] = f"""WITH {RAW_WEATHER}, {RAW_COMMUNES}, {LISTED}, {COMMUNES}, {RAW_HEALTH}, {HEALTH},
taken AS (
  SELECT CAST(time AS DATE) AS date, nom_poi AS code_insee, ville,
    CASE WHEN weather_code < 40 THEN numero_departement WHEN weather_code < 70 THEN 'XX' END AS numero_departement,
    temperature_2m_max AS temperature_max, apparent_temperature_max AS temperature_ressentie_max, reading_id
  FROM raw_weather WHERE time IS NOT NULL AND nom_poi IS NOT NULL),
recorded AS (
  SELECT year(annee) AS annee, {padded('departement_code', 2)} AS departement_code, nb_jours_canicule FROM health),
own AS (
  SELECT t.*, r.departement_code AS own_code FROM taken t
  LEFT JOIN (SELECT DISTINCT departement_code FROM recorded) r ON r.departement_code = {padded('t.numero_departement', 2)}),
named AS (
  SELECT DISTINCT {fold('ville')} AS name_key, {padded('numero_departement', 2)} AS departement_code FROM communes
  WHERE {padded('numero_departement', 2)} IN (SELECT departement_code FROM recorded)),
placed AS (
  SELECT o.* EXCLUDE (own_code), coalesce(own_code, n.departement_code) AS departement_code
  FROM own o LEFT JOIN named n ON own_code IS NULL AND n.name_key = {fold('o.ville')}),
crossed AS (
  SELECT p.*, r.nb_jours_canicule FROM placed p
  LEFT JOIN recorded r ON r.departement_code = p.departement_code AND r.annee = year(p.date))
SELECT * REPLACE ({day('crossed.date')} AS date) FROM crossed
QUALIFY row_number() OVER (PARTITION BY crossed.date, code_insee ORDER BY
  temperature_max IS NULL, temperature_ressentie_max IS NULL, reading_id, departement_code NULLS LAST,
  nb_jours_canicule NULLS LAST) = 1"""
_KEPT = [f.name for f in schemas.RAW_WEATHER.fields if f.name not in ("row_hash", "insere_a")]
_GIVEN = ("time nom_poi ville latitude_poi longitude_poi numero_departement weather_code temperature_2m_mean "
          "temperature_2m_min temperature_2m_max apparent_temperature_mean apparent_temperature_max "
          "relative_humidity_2m_mean precipitation_sum rain_sum wind_speed_10m_mean wind_speed_10m_max "
          "wind_gusts_10m_max pressure_msl_mean sunshine_duration").split()
SQL["s14_json_append"] = f"WITH {RAW_WEATHER} SELECT " + ", ".join(
    f"{STAMP} AS time" if c == "time" else c if c in _GIVEN else f"CAST(NULL AS DOUBLE) AS {c}" for c in _KEPT) + " FROM raw_weather"
SQL["s18_step_metrics"] = """
SELECT event_type AS step, value / 1000 AS emissions_kg_co2, value AS duration_seconds, 'ok' AS status FROM events
UNION ALL SELECT 'event ' || event_id, NULL, value + 1, 'late' FROM events"""
SQL["s18_emissions_log"] = """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, CAST(event_id AS VARCHAR) AS run_id, event_type AS project_name,
  value / 1000 AS emissions, value AS duration FROM events"""
