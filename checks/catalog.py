"""One query per operator, each over whole given tables: name -> f(spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import adapters as A
from heatmart import schemas
from heatmart.functions import dates, text
from heatmart.operators import (
    analytics, append, dedup, gate, health, presence, quality, resolve, runs, scale, states, stats)
from heatmart.plans import build, marts, staging
from heatmart.sources import landing, raw as scan, runlog, sinks, versions
from heatmart.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Reference day of the events table, one day past its last reading.
EVENTS_AS_OF = date(2024, 1, 31)
# First day not yet stored when the events are collected again.
EVENTS_STORED_BEFORE = "2024-01-16"
# Variables of the payloads made from events.
PAYLOAD = ["weather_code", "temperature_2m_mean", "temperature_2m_max"]


def comparable(df: DataFrame) -> DataFrame:
    """Portable types: days and times as text, wide integers, no audit columns."""
    out = []
    for f in df.schema.fields:
        if f.name in schemas.AUDIT_COLUMNS:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: comparable(function(spark, sf_dir))
    return function


def six(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals for unrounded figures, whose last bits depend on summation order.

    The shift of a thousandth of a millionth keeps exact ties off the boundary.
    """
    return df.withColumns({c: F.rint(F.col(c) * 1e6 + 0.001) / 1e6 + 0.0 for c in columns})


# ---- scans, sources, sinks --------------------------------------------------


@query
def s1_weather_scan(spark, d):
    return scan.weather(A.raw_weather(spark, d)).select(
        "reading_id", "time", "nom_poi", "ville", "temperature_2m_max")


@query
def s2_commune_scan(spark, d):
    return scan.communes(A.raw_communes(spark, d))


@query
def s3_heat_health_scan(spark, d):
    return scan.present(A.raw_heat_health(spark, d), ["annee", "libgeo", "nb_j_can"])


@query
def s4_winter_scan(spark, d):
    return scan.present(A.raw_winter(spark, d), ["date", "valeur"])


def _payloads(spark, d) -> DataFrame:
    """One landed payload per event: two locations, three days each, ragged arrays."""
    body = F.expr("""to_json(array(
        named_struct('daily', named_struct(
            'time', transform(sequence(0, 2), i -> cast(date_add(to_date(ts), i) as string)),
            'weather_code', array(event_type, cast(user_id as string), '3'),
            'temperature_2m_mean', array(cast(value as string), null, cast(value + 1 as string)),
            'temperature_2m_max', array(cast(value + 2 as string)))),
        named_struct('daily', named_struct(
            'time', transform(sequence(0, 2), i -> cast(date_add(to_date(ts), i) as string)),
            'weather_code', cast(null as array<string>),
            'temperature_2m_mean', array(cast(value + 3 as string), 'n/a'),
            'temperature_2m_max', array('x', null, cast(value + 4 as string))))))""")
    return A.table(spark, d, "events").select(F.col("event_id").alias("batch_id"),
                                              body.alias("body"))


def _locations(spark, d) -> DataFrame:
    return (A.table(spark, d, "events")
            .select("event_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"), "user_id")
            .selectExpr("event_id as batch_id", "pos", "event_id || '-' || pos as nom_poi",
                        "'Ville ' || user_id as ville", "user_id / 10 as latitude_poi",
                        "pos / 10 as longitude_poi",
                        "cast(pos as string) as numero_departement").distinct())


@query
def s5_daily_arrays(spark, d):
    parsed = landing.parse_payloads(_payloads(spark, d), variables=PAYLOAD)
    return landing.daily_readings(parsed, _locations(spark, d), PAYLOAD)


@query
def s6_daily_arrays_strict(spark, d):
    parsed = landing.parse_payloads(_payloads(spark, d), variables=PAYLOAD)
    return landing.complete_readings(parsed, _locations(spark, d), PAYLOAD)


def _drifted(spark, d) -> DataFrame:
    """One landed payload per event in one of four shapes: a list that also holds a number, a
    wrapper, a bare location, a text broken off; with a variable and a remark nobody asked for."""
    body = F.expr("""transform(array(to_json(named_struct('note', event_type, 'daily', named_struct(
            'time', transform(sequence(0, 1), i -> cast(date_add(to_date(ts), i) as string)),
            'weather_code', named_struct('unit', 'wmo'),
            'temperature_2m_mean', array(cast(value as string), 'n/a'),
            'temperature_2m_max', array(user_id, null),
            'uv_index_max', array(user_id, event_id))))),
        one -> case pmod(user_id, 4) when 0 then '[' || one || ', 7]' when 1 then '{"results": [' || one || ']}'
                    when 2 then one else substring(one, 1, length(one) - 1) end)[0]""")
    return A.table(spark, d, "events").select(F.col("event_id").alias("batch_id"), body.alias("body"))


@query
def s5_drifted_arrays(spark, d):
    parsed = landing.parse_payloads(_drifted(spark, d), variables=PAYLOAD)
    return landing.daily_readings(parsed, _locations(spark, d), PAYLOAD)


@query
def s5_other_variables(spark, d):
    """Values of the variables that nobody asked for, one row each."""
    found = landing.other_variables(landing.parse_payloads(_drifted(spark, d), variables=PAYLOAD), PAYLOAD)
    return found.select("batch_id", "pos", "variable", F.posexplode(
        F.try_variant_get("values", "$", "array<long>")).alias("i", "value"))


@query
def s5_unreadable(spark, d):
    """Landed bodies that are no JSON."""
    return landing.unreadable(_drifted(spark, d)).select("batch_id")


def _pages(spark, d) -> DataFrame:
    """One landed page of two health records per customer."""
    return A.table(spark, d, "customer").select(F.expr("""to_json(named_struct('results',
        transform(array(0, 1), i -> named_struct('dep', cast(c_nationkey as string),
            'libgeo', c_name, 'reg', c_mktsegment, 'reglib', 'Île ' || c_mktsegment,
            'annee', cast(2000 + i as string), 'nb_j_can', c_acctbal + i))))""").alias("body"))


@query
def s8_pages_flatten(spark, d):
    return landing.parse_pages(_pages(spark, d))


@query
def s9_heat_record_map(spark, d):
    return landing.heat_record(landing.parse_pages(_pages(spark, d)))


@query
def s10_tagged_union(spark, d):
    return landing.tagged_union({
        "Grippe": A.table(spark, d, "customer").selectExpr(
            "c_custkey as id", "c_name as libelle", "c_acctbal as valeur"),
        "Bronchiolite": A.table(spark, d, "supplier").selectExpr(
            "s_suppkey as id", "s_name as libelle", "s_acctbal as valeur"),
        "Gastro-enterite aigue": A.table(spark, d, "part").selectExpr(
            "p_partkey as id", "p_name as libelle", "p_brand as marque"),
    })


@query
def s11_locations(spark, d):
    return scan.locations(A.raw_communes(spark, d))


@query
def s12_locations_backfill(spark, d):
    return scan.backfill_locations(A.raw_communes(spark, d))


@query
def s13_schema_conform(spark, d):
    loose = (A.raw_weather(spark, d)
             .withColumn("temperature_2m_max", F.col("temperature_2m_max").cast("string"))
             .withColumn("row_hash", F.col("reading_id")))
    return sinks.conform(loose, schemas.RAW_WEATHER)


@query
def s14_json_append(spark, d):
    """Readings appended twice as JSON lines, read back under the stored schema."""
    path = f"{_stream_folder(spark)}/json"
    readings = A.raw_weather(spark, d)
    for part in (readings.where("sunshine_duration < 25000"), readings.where("not sunshine_duration < 25000")):
        sinks.append(part, path, schemas.RAW_WEATHER, "json")
    return spark.read.schema(schemas.RAW_WEATHER).json(path).drop("row_hash", "insere_a")


@query
def s18_step_metrics(spark, d):
    """Steps of a metrics object per event, some without a name of their own."""
    texts = A.table(spark, d, "events").selectExpr("""to_json(map(
        event_type, named_struct('step', event_type, 'emissions_kg_co2', value / 1000, 'duration_seconds', value,
                                 'status', 'ok'),
        'event ' || event_id, named_struct('step', cast(null as string), 'emissions_kg_co2', cast(null as double),
                                           'duration_seconds', value + 1, 'status', 'late'))) as value""")
    return runlog.parse_steps(texts)


@query
def s18_emissions_log(spark, d):
    """An emissions log written as CSV, read under its schema."""
    columns = {"timestamp": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')", "run_id": "cast(event_id as string)",
               "project_name": "event_type", "emissions": "value / 1000", "duration": "value"}
    log = A.table(spark, d, "events").selectExpr(*[
        f"{columns.get(f.name, 'cast(null as string)')} as {f.name}" for f in schemas.EMISSIONS_LOG.fields])
    path = f"{_stream_folder(spark)}/csv"
    log.write.option("header", True).csv(path)
    return runlog.read_emissions(spark, path).select(*columns)


@query
def s17_inventory(spark, d):
    names = ("region nation customer supplier part orders lineitem events documents embeddings "
             "pages benchmark labels conversations").split()
    listed = {("reference" if n in ("region", "nation") else "donnees", n): A.table(spark, d, n)
              for n in names}
    return runs.inventory(listed).drop("taille_mo")


def _stored_panel(spark, d) -> DataFrame:
    return A.daily_panel(spark, d).where("date < '2001-01-01'")


@query
def s19_incremental_delta(spark, d):
    fresh = A.daily_panel(spark, d).select("date", "code_insee", "temperature_moyenne")
    return sinks.delta(fresh, _stored_panel(spark, d), ["date", "code_insee"])


@query
def s19_incremental_fact(spark, d):
    """The fact after a build of the readings before a day and an update with all of them."""
    weather = A.raw_weather(spark, d)
    others = [A.raw_communes(spark, d), A.raw_heat_health(spark, d), A.raw_winter(spark, d)]
    root = f"{_stream_folder(spark)}/tables"
    build.build(spark, build.Raw(weather.where("time < '1998-07-10'"), *others), root)
    built = build.update(spark, build.Raw(weather, *others), root, date(1998, 6, 15))
    return built["fct_daily"].drop("date_month")


def _merged_late(spark, d, merges: int = 1) -> tuple[dict[str, DataFrame], str]:
    """A build of the shorter sunshine, then merges that bring every month late and repeated readings."""
    weather = A.raw_weather(spark, d)
    others = [A.raw_communes(spark, d), A.raw_heat_health(spark, d), A.raw_winter(spark, d)]
    root = f"{_stream_folder(spark)}/tables"
    early = F.col("sunshine_duration") < 25_000
    build.build(spark, build.Raw(weather.where(early), *others), root)
    if merges > 1:
        build.merge(spark, weather.where(~early & F.col("temperature_2m_max").isNull()), root)
    # readings stored before come once more
    return build.merge(spark, weather.where(~early | (F.col("sunshine_duration") < 10_000)), root), root


@query
def s19_late_fact(spark, d):
    return _merged_late(spark, d, 2)[0]["fct_daily"].drop("date_month")


@query
def s19_late_department_years(spark, d):
    """Department-years from monthly states that late and replaced readings were merged into."""
    table = build.monthly_states(spark, _merged_late(spark, d)[1])
    return states.department_year(table).join(states.department_summer(table), ["annee", "departement"], "left")


@query
def s19_late_coverage(spark, d):
    """Size and extent from the days' bitmaps that late and repeated readings were merged into."""
    return presence.coverage(*build.daily_presence(spark, _merged_late(spark, d)[1]))


@query
def s19_state_heat_days(spark, d):
    """Heat days per year from the states of a build updated from a day on."""
    weather = A.raw_weather(spark, d)
    others = [A.raw_communes(spark, d), A.raw_heat_health(spark, d), A.raw_winter(spark, d)]
    root = f"{_stream_folder(spark)}/tables"
    build.build(spark, build.Raw(weather.where("time < '1998-07-10'"), *others), root)
    build.update(spark, build.Raw(weather, *others), root, date(1998, 6, 15))
    return states.heat_days_by_year(build.monthly_states(spark, root))


# ---- projections and predicates ---------------------------------------------


@query
def p2_not_null_filter(spark, d):
    needed = ["time", "nom_poi", "temperature_2m_max", "apparent_temperature_max"]
    return scan.present(A.raw_weather(spark, d), needed).select("reading_id", *needed)


@query
def p3_blank_filter(spark, d):
    named = A.table(spark, d, "customer").selectExpr(
        "c_custkey", "case when c_acctbal < 0 then ' \t  ' else c_name || ' ' end as ville")
    return scan.not_blank(named, "ville")


@query
def p5_key_kinds(spark, d):
    point, town = F.col("nom_poi"), F.col("ville")
    return A.raw_weather(spark, d).select(
        "reading_id", text.lookup_code(point).alias("key_code"),
        text.lookup_name(point).alias("key_point"), text.fold_name(town).alias("key_town"))


@query
def p8_casts(spark, d):
    return A.table(spark, d, "orders").selectExpr(
        "o_orderkey", "cast(o_custkey as string) as numero", "cast(o_orderdate as date) as date",
        "cast(cast(o_totalprice as string) as double) as valeur",
        "cast(o_custkey as double) as latitude")


@query
def p11_ranges(spark, d):
    panel = dates.between_days(A.daily_panel(spark, d), date(1995, 6, 1), date(2000, 12, 31))
    return panel.where(F.month("date").between(6, 9) & F.year("date").between(1996, 2000)).select(
        "date", "code_insee", "temperature_moyenne")


@query
def p12_lookback(spark, d):
    events = A.event_readings(spark, d)
    return events.where(dates.since_days(F.col("date"), EVENTS_AS_OF, 10)).select(
        "event_id", "date", "code_insee")


@query
def p13_window_missing(spark, d):
    first, last = dates.collection_window(date(2001, 8, 6))
    return append.missing_keys(scan.locations(A.raw_communes(spark, d)),
                               A.raw_weather(spark, d), first, last)


@query
def p16_name_fallback(spark, d):
    return A.raw_weather(spark, d).select(
        "reading_id", text.display_name(F.col("ville"), F.col("nom_poi")).alias("nom"))


@query
def p17_fill_zero(spark, d):
    kept = A.daily_panel(spark, d).select("date", "code_insee", "deces", "hospitalisations")
    return kept.na.fill(0, ["deces", "hospitalisations"])


@query
def p18_dept_pad(spark, d):
    return A.table(spark, d, "customer").select(
        "c_custkey", text.pad_department(F.col("c_nationkey")).alias("dept"),
        text.pad_department(F.col("c_custkey")).alias("long_code"))


# ---- joins -------------------------------------------------------------------


@query
def j1_place_resolution(spark, d):
    readings = scan.weather(A.raw_weather(spark, d)).select(
        "reading_id", "nom_poi", "ville", "temperature_2m_max")
    return resolve.resolve_places(readings, staging.stg_communes(A.raw_communes(spark, d)))


@query
def j2_annual_summer(spark, d):
    panel = A.daily_panel(spark, d)
    return health.annual_with_summer(health.department_year(panel),
                                     health.department_summer(panel))


@query
def j3_weather_health(spark, d):
    return health.with_health(health.department_year(A.daily_panel(spark, d)),
                              scan.heat_health(A.raw_heat_health(spark, d)))


@query
def j4_key_coverage(spark, d):
    return health.key_coverage(A.daily_panel(spark, d), A.raw_heat_health(spark, d),
                               "departement", "libgeo")


@query
def j5_key_gaps(spark, d):
    return health.key_gaps(
        A.table(spark, d, "events").selectExpr("cast(user_id as string) as code"),
        A.table(spark, d, "supplier").selectExpr("cast(s_suppkey as string) as code"),
        "code", "code")


def _collected(spark, d) -> DataFrame:
    """Events as a collected batch, under padded codes."""
    return A.table(spark, d, "events").selectExpr(
        "ts as time", "lpad(cast(user_id as string), 5, '0') as nom_poi", "event_id", "value")


def _already_stored(spark, d) -> DataFrame:
    """The days collected earlier, under the codes of that time."""
    return A.table(spark, d, "events").where(f"ts < '{EVENTS_STORED_BEFORE}'").selectExpr(
        "ts as time", "cast(user_id as string) as nom_poi")


@query
def j6_append_new_keys(spark, d):
    return append.new_readings(_collected(spark, d), _already_stored(spark, d),
                               dedup.ascending(["event_id"]), EVENTS_AS_OF)


@query
def j7_append_new_hash(spark, d):
    events = A.table(spark, d, "events").selectExpr(
        "ts as time", "'Ville ' || user_id as nom_poi", "event_id")
    stored = events.where(f"time < '{EVENTS_STORED_BEFORE}'").select("time", "nom_poi")
    return append.new_by_hash(events, stored, date(2024, 1, 1), date(2024, 1, 30))


@query
def j8_append_record_key(spark, d):
    records = A.table(spark, d, "events").selectExpr(
        "cast(user_id as string) as code_departement", "to_date(ts) as annee",
        "event_id", "value as nombre_jours")
    stored = records.where(f"annee < '{EVENTS_STORED_BEFORE}'")
    return landing.load_records(records, stored, key=["code_departement", "annee"])


@query
def j9_record_hash_dedup(spark, d):
    records = A.table(spark, d, "documents").select("text", "lang", "source")
    kept = landing.load_records(records)
    return kept.select(F.sha2("text", 256).alias("text_sha"), "lang", "source")


@query
def j10_health_enrichment(spark, d):
    """Readings whose department is right, unknown or missing, enriched by code or else by town name."""
    readings = scan.weather(A.raw_weather(spark, d)).where("nom_poi is not null").selectExpr(
        "to_date(time) as date", "nom_poi as code_insee", "ville",
        "case when weather_code < 40 then numero_departement when weather_code < 70 then 'XX' end as numero_departement",
        "temperature_2m_max as temperature_max", "apparent_temperature_max as temperature_ressentie_max", "reading_id")
    return health.enriched(readings, staging.stg_communes(A.raw_communes(spark, d)),
                           scan.heat_health(A.raw_heat_health(spark, d)), ["reading_id"])


# ---- aggregates --------------------------------------------------------------


@query
def a1_coverage(spark, d):
    return quality.coverage(A.daily_panel(spark, d))


@query
def a2_null_profile(spark, d):
    return quality.null_profile(A.daily_panel(spark, d))


@query
def a3_null_profile_raw(spark, d):
    return quality.null_profile(A.raw_weather(spark, d), quality.PROFILED_RAW)


@query
def a4_bounds(spark, d):
    return quality.bounds(A.daily_panel(spark, d))


@query
def a5_coherence(spark, d):
    return quality.coherence(A.daily_panel(spark, d))


@query
def a6_key_uniqueness(spark, d):
    return quality.key_uniqueness(A.daily_panel(spark, d))


@query
def a7_continuity(spark, d):
    return quality.continuity(A.daily_panel(spark, d))


@query
def a8_incomplete_days(spark, d):
    return quality.incomplete_days(A.daily_panel(spark, d), 6)


def _presence(spark, d) -> tuple[DataFrame, DataFrame]:
    panel = A.daily_panel(spark, d)
    places = presence.numbered_places(panel)
    return scale.cut_lineage(presence.presence(panel, places)), places


@query
def a1_coverage_bitmaps(spark, d):
    return presence.coverage(*_presence(spark, d))


@query
def a6_key_uniqueness_bitmaps(spark, d):
    return presence.key_uniqueness(_presence(spark, d)[0])


@query
def a7_continuity_bitmaps(spark, d):
    return presence.continuity(_presence(spark, d)[0])


@query
def a8_incomplete_days_bitmaps(spark, d):
    return presence.incomplete_days(_presence(spark, d)[0], 6)


@query
def a9_name_variants(spark, d):
    events = A.table(spark, d, "events").selectExpr(
        "cast(user_id as string) as code_insee", "event_type as ville")
    return quality.name_variants(events)


def _loads(spark, d) -> DataFrame:
    lines = A.table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    orders = A.table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query
def a10_insert_trace(spark, d):
    return analytics.insertion_trace(_loads(spark, d), "l_shipdate", "o_orderdate")


@query
def a11_dept_years(spark, d):
    return analytics.department_years(scan.heat_health(A.raw_heat_health(spark, d)))


@query
def a12_seasonality(spark, d):
    return six(analytics.seasonality(A.daily_panel(spark, d)), "temp_moy", "temp_max", "temp_min")


@query
def a13_yearly_trend(spark, d):
    return analytics.yearly_trend(A.daily_panel(spark, d))


@query
def a14_department_climate(spark, d):
    return analytics.department_climate(A.daily_panel(spark, d), 1995, 2001)


@query
def a15_region_climate(spark, d):
    departments = analytics.department_climate(A.daily_panel(spark, d), 1995, 2001)
    return six(analytics.region_climate(departments), "temp_moyenne")


def built_panel(spark, d) -> DataFrame:
    """The wide frame built by the models from the raw shapes."""
    # read twice, so stored as by a build
    communes = scale.cut_lineage(staging.stg_communes(A.raw_communes(spark, d)))
    weather = staging.stg_weather(A.raw_weather(spark, d), communes)
    return marts.wide(marts.fct_daily(weather), communes)


@query
def a16_heat_days_year(spark, d):
    return analytics.heat_days_by_year(built_panel(spark, d))


@query
def a17_heat_days_month(spark, d):
    return analytics.heat_days_by_month(A.daily_panel(spark, d))


@query
def a18_dept_year(spark, d):
    return health.department_year(A.daily_panel(spark, d))


@query
def a19_dept_summer(spark, d):
    return health.department_summer(A.daily_panel(spark, d))


def _crossed(spark, d) -> DataFrame:
    return health.weather_health(A.daily_panel(spark, d),
                                 scan.heat_health(A.raw_heat_health(spark, d)))


@query
def a20_weather_health(spark, d):
    return _crossed(spark, d)


@query
def a21_corr_matrix(spark, d):
    return six(stats.correlation_matrix(A.daily_panel(spark, d)), "r")


@query
def a22_corr_health(spark, d):
    return six(health.health_correlations(_crossed(spark, d)), "r_temp_ete", "r_jours_35")


@query
def a23_describe(spark, d):
    return stats.summary(A.daily_panel(spark, d))


@query
def a24_histogram(spark, d):
    return six(stats.histograms(A.daily_panel(spark, d)), "lower", "upper")


@query
def a25_linear_trend(spark, d):
    yearly = analytics.yearly_trend(A.daily_panel(spark, d))
    return six(analytics.linear_trend(yearly, 2001), "pente", "ordonnee", "par_decennie")


@query
def a26_batch_gate(spark, d):
    return six(append.batch_gate(A.raw_weather(spark, d)), "missing_pct")


@query
def a27_ingest_counts(spark, d):
    return append.ingest_counts(_collected(spark, d), _already_stored(spark, d), EVENTS_AS_OF)


@query
def a29_step_totals(spark, d):
    steps = A.table(spark, d, "events").selectExpr(
        "event_type as step", "value / 1000 as emissions_kg_co2", "value as duration_seconds")
    return six(runs.step_totals(steps), "co2_kg", "time_s")


@query
def a30_run_history(spark, d):
    return analytics.run_history(_loads(spark, d), "l_shipdate", "o_orderdate", "o_custkey")


@query
def a31_day_coverage(spark, d):
    return quality.day_coverage(A.daily_panel(spark, d), date(2001, 8, 6))


@query
def a32_fact_size(spark, d):
    return quality.fact_size(A.daily_panel(spark, d))


@query
def a33_period_region(spark, d):
    return analytics.period_region(A.daily_panel(spark, d))


@query
def a34_volume_log(spark, d):
    log = A.table(spark, d, "events").selectExpr("ts", "value * 1e8 as bytes")
    return six(analytics.volume_log(log, EVENTS_AS_OF), "gb_billed")


# ---- windows and top-k -------------------------------------------------------


@query
def w1_commune_dedup(spark, d):
    listed = scan.communes(A.raw_communes(spark, d))
    return dedup.one_per_commune(listed, "code")


@query
def w2_weather_dedup(spark, d):
    return dedup.best_reading(A.event_readings(spark, d), ["date", "code_insee"],
                              ["event_id"]).drop("ts")


@query
def w3_latest_wins(spark, d):
    return dedup.latest_per_key(A.event_readings(spark, d), ["date", "code_insee"], "ts",
                                ["event_id"]).drop("ts")


@query
def w4_heatwave_3day(spark, d):
    thresholds = A.table(spark, d, "nation").selectExpr(
        "n_name as departement", "n_nationkey / 10 - 2 as seuil_min",
        "n_nationkey / 10 + 15 as seuil_max")
    return six(analytics.heat_waves(A.daily_panel(spark, d), thresholds),
               "moyenne_min", "moyenne_max")


@query
def o4_top_bottom(spark, d):
    return analytics.warmest_and_coolest(
        analytics.department_climate(A.daily_panel(spark, d), 1995, 2001))


# ---- scalar functions --------------------------------------------------------


def _documents(spark, d) -> DataFrame:
    # the two engines upper-case this letter differently
    return A.table(spark, d, "documents").select(
        "doc_id", F.replace(F.col("text"), F.lit("ß"), F.lit("ss")).alias("text"))


@query
def f1_fold_name(spark, d):
    return _documents(spark, d).select(
        "doc_id", F.sha2(text.fold_name(F.col("text")), 256).alias("folded"))


@query
def f2_region_key(spark, d):
    return _documents(spark, d).select(
        "doc_id", F.sha2(text.region_key(F.col("text")), 256).alias("region_key"))


def _codes(spark, d) -> DataFrame:
    """Codes of every length, padded texts, both cases of the island letters."""
    return A.table(spark, d, "orders").selectExpr(
        "o_orderkey", """case o_orderstatus when 'F' then cast(o_orderkey * 37 as string)
            when 'O' then ' ' || cast(o_custkey as string) || '\t'
            else case when o_custkey % 2 = 0 then '2A' else '2b' end
                 || lpad(cast(o_custkey % 1000 as string), 3, '0') end as code""")


@query
def f3_code_staging(spark, d):
    return _codes(spark, d).select("o_orderkey", text.staging_code(F.col("code")).alias("code"))


@query
def f4_code_collector(spark, d):
    return _codes(spark, d).select("o_orderkey", text.collector_code(F.col("code")).alias("code"))


@query
def f18_row_hash(spark, d):
    return A.table(spark, d, "events").select(
        "event_id", text.reading_hash(F.col("ts"), F.col("user_id")).alias("row_hash"))


# ---- data-quality checks -----------------------------------------------------


@query
def q1_not_null(spark, d):
    communes = staging.stg_communes(A.raw_communes(spark, d))
    day = marts.dim_date(A.raw_weather(spark, d))
    models = {"stg_communes": communes, "dim_commune": marts.dim_commune(communes),
              "dim_date": day, "stg_heat_health": staging.stg_heat_health(
                  A.raw_heat_health(spark, d))}
    found = [quality.run_checks(n, df, quality.Checks(not_null=quality.DECLARED[n].not_null))
             for n, df in models.items()]
    found.append(quality.run_checks("panel", A.daily_panel(spark, d), quality.Checks(
        not_null=["date", "code_insee", "ville", "departement", "temperature_maximale"])))
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


@query
def q2_unique(spark, d):
    return quality.repeated_keys(scan.communes(A.raw_communes(spark, d)), ["code"])


@query
def q3_unique_composite(spark, d):
    return quality.repeated_keys(A.event_readings(spark, d), ["date", "code_insee"])


@query
def q4_range(spark, d):
    panel = A.daily_panel(spark, d)
    checks = quality.Checks(ranges={**quality.RANGES, "temperature_maximale": (0.0, 40.0)})
    return quality.run_checks("panel", panel, checks)


@query
def q5_relationship(spark, d):
    orders = A.table(spark, d, "orders").selectExpr(
        "lpad(cast(o_custkey as string), 5, '0') as code_insee")
    return quality.orphans(orders, staging.stg_communes(A.raw_communes(spark, d)), "code_insee")


@query
def q6_coverage(spark, d):
    return quality.low_coverage(A.daily_panel(spark, d), "departement", 350)


@query
def q7_sentinels(spark, d):
    panel = A.daily_panel(spark, d).withColumn(
        "pression_moyenne",
        F.expr("case when alerte then -999.0D else pression_moyenne end"))
    return quality.sentinels(panel, ["pression_moyenne", "humidite_moyenne"])


@query
def q_declared_checks(spark, d):
    communes = staging.stg_communes(A.raw_communes(spark, d))
    # checks read a stored table, as after a build
    fact = scale.cut_lineage(
        marts.fct_daily(staging.stg_weather(A.raw_weather(spark, d), communes)))
    checks = quality.Checks(
        not_null=quality.DECLARED["fct_daily"].not_null + ["temperature_max"],
        unique=quality.DECLARED["fct_daily"].unique, ranges=quality.RANGES,
        no_sentinel=["pression_moyenne"], more_than={"code_insee": 350})
    return quality.run_checks("fct_daily", fact, checks)


def _written_fact(spark, d) -> tuple[DataFrame, str]:
    """The fact written with its checks: their answers, and the folder of the rows that fail."""
    folder = _stream_folder(spark)
    communes = staging.stg_communes(A.raw_communes(spark, d))
    checks = quality.Checks(
        not_null=quality.DECLARED["fct_daily"].not_null + ["temperature_max"],
        unique=quality.DECLARED["fct_daily"].unique, ranges=quality.RANGES,
        no_sentinel=["pression_moyenne"], more_than={"code_insee": 350})
    found = gate.write_checked(marts.fct_daily(staging.stg_weather(A.raw_weather(spark, d), communes)),
                               "fct_daily", checks, f"{folder}/fact", f"{folder}/quarantine")
    return found, f"{folder}/quarantine"


@query
def q_checked_write(spark, d):
    return _written_fact(spark, d)[0]


@query
def q_quarantine(spark, d):
    return spark.read.parquet(_written_fact(spark, d)[1]).select(
        "date", "code_insee", "temperature_max", F.array_join("reasons", ", ").alias("reasons"))


# ---- models ------------------------------------------------------------------


@query
def m_stg_communes(spark, d):
    return staging.stg_communes(A.raw_communes(spark, d))


@query
def m_stg_weather(spark, d):
    return staging.stg_weather(A.raw_weather(spark, d),
                               staging.stg_communes(A.raw_communes(spark, d)))


@query
def m_stg_heat_health(spark, d):
    return staging.stg_heat_health(A.raw_heat_health(spark, d))


@query
def m_stg_winter(spark, d):
    return staging.stg_winter(A.raw_winter(spark, d))


@query
def m_dim_commune(spark, d):
    return marts.dim_commune(staging.stg_communes(A.raw_communes(spark, d)))


@query
def m_dim_region(spark, d):
    return marts.dim_region(staging.stg_communes(A.raw_communes(spark, d)))


@query
def m_dim_date(spark, d):
    return marts.dim_date(A.raw_weather(spark, d))


@query
def m_fct_daily(spark, d):
    return marts.fct_daily(staging.stg_weather(
        A.raw_weather(spark, d), staging.stg_communes(A.raw_communes(spark, d))))


@query
def m_wide(spark, d):
    return built_panel(spark, d)


# ---- streams -----------------------------------------------------------------


def _event_stream(spark, d) -> DataFrame:
    schema = A.table(spark, d, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
            .selectExpr("cast(ts as timestamp) as time", "cast(user_id as string) as nom_poi",
                        "value as temperature_maximale", "event_id"))


def _stream_folder(spark) -> str:
    return f"{scale.shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"


@query
def t1_stream_first(spark, d):
    """Keys kept by the streaming first-per-(day, place), read back from its sink."""
    folder = _stream_folder(spark)
    stream = _event_stream(spark, d).withColumn("date", F.to_date("time"))
    first = incremental.first_readings(stream, ["date", "nom_poi"])
    (first.writeStream.option("checkpointLocation", f"{folder}/state").format("parquet")
     .option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{folder}/out").select("date", "nom_poi")


@query
def t2_stream_append(spark, d):
    """Monthly hot days after the stream has appended every reading once per key."""
    folder = _stream_folder(spark)
    incremental.follow(_event_stream(spark, d), f"{folder}/fact", f"{folder}/report",
                       f"{folder}/state", dedup.ascending(["event_id"])).awaitTermination()
    return versions.read(spark, f"{folder}/report").select(
        "date_month", "jours_sup_30", "jours_sup_35", "jours_sup_40")


def _best_stream(spark, d) -> str:
    """Follows the events as readings with many copies per (day, place); the folder."""
    schema = A.table(spark, d, "events").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
              .selectExpr("cast(ts as timestamp) as time", "to_date(ts) as date", "cast(user_id as string) as code_insee",
                          "case when event_type <> 'error' then value end as temperature_max",
                          "case when event_type <> 'click' then value + 1 end as temperature_ressentie_max",
                          "event_type", "event_id"))
    folder = _stream_folder(spark)
    incremental.follow_best(stream, f"{folder}/fact", f"{folder}/report", f"{folder}/state", ["event_id"],
                            dated=True).awaitTermination()
    return folder


@query
def t1_stream_best(spark, d):
    """The best reading per (day, place) after the stream, as the batch choice has it."""
    return spark.read.parquet(f"{_best_stream(spark, d)}/fact").drop("time", "date_month")


@query
def t2_stream_best_report(spark, d):
    """Monthly hot days of the best readings, from the report the stream kept."""
    return versions.read(spark, f"{_best_stream(spark, d)}/report").select(
        "date_month", "lignes", *[f"jours_sup_{t}" for t in states.HOT])
