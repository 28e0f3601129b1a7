"""Landed files, appends, sinks and run logs."""

import json
from pathlib import Path
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from heatmart import schemas
from heatmart.functions.dates import between_days
from heatmart.operators import append, dedup, runs
from heatmart.sources import landing, runlog, sinks
from support import plan, rows

DAYS = ["2026-08-01", "2026-08-02", "2026-08-03"]
VARIABLES = ["weather_code", "temperature_2m_mean", "temperature_2m_max"]


def location(**arrays):
    return {"daily": {"time": DAYS, **arrays}}


PAYLOADS = [
    [location(temperature_2m_mean=[20, None, 22.5], temperature_2m_max=[30], weather_code=["x", 3]),
     location(temperature_2m_mean=None, temperature_2m_max=["31.5", True, {"a": 1}])],
    {"results": [location(temperature_2m_mean=[1.0, 2.0, 3.0])]},
    location(temperature_2m_mean=[7, 8, 9]),
    {"error": True}, [],
]


@pytest.fixture(scope="module")
def parsed(spark):
    landed = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(PAYLOADS)],
                                   "batch_id int, body string")
    return landing.parse_payloads(landed, variables=VARIABLES)


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(
        [(b, p, f"{b}{p}", None, 1.0, 2.0, "01") for b in range(5) for p in range(2)],
        "batch_id int, pos int, nom_poi string, ville string, latitude_poi double,"
        " longitude_poi double, numero_departement string")


def test_daily_arrays(parsed, places):
    got = landing.daily_readings(parsed, places, VARIABLES)
    found = {(r.nom_poi, r.time.day): (r.weather_code, r.temperature_2m_mean, r.temperature_2m_max)
             for r in got.collect()}
    assert found == {
        ("00", 1): (None, 20.0, 30.0), ("00", 2): (3.0, None, None), ("00", 3): (None, 22.5, None),
        ("01", 1): (None, None, 31.5), ("01", 2): (None, None, None), ("01", 3): (None, None, None),
        ("10", 1): (None, 1.0, None), ("10", 2): (None, 2.0, None), ("10", 3): (None, 3.0, None),
        ("20", 1): (None, 7.0, None), ("20", 2): (None, 8.0, None), ("20", 3): (None, 9.0, None)}


def test_payloads_are_parsed_once_and_keep_what_nobody_asked_for(spark, capsys):
    bodies = [json.dumps([location(temperature_2m_mean=[1], uv_index_max=[5, "x"]), 7, None]), "{broken", None, "null",
              json.dumps({"results": [location(temperature_2m_mean={"a": 1})]}), '{"daily": {"time": "x", "temperature_2m_mean": [1.50]}}']
    landed = spark.createDataFrame(list(enumerate(bodies)), "batch_id int, body string")
    parsed = landing.parse_payloads(landed, variables=VARIABLES)
    parsed.select("location", "source").explain("extended")
    assert capsys.readouterr().out.split("== Optimized")[1].split("== Physical")[0].lower().count("parsejson(") == 1
    got = {(r.batch_id, r.pos): r.location.daily for r in parsed.collect()}
    assert sorted(got) == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 0), (3, 0), (4, 0), (5, 0)]
    assert (got[0, 0].time, got[0, 0].temperature_2m_mean) == (DAYS, ["1"]) and got[0, 1].time is None
    assert (got[4, 0].time, got[4, 0].temperature_2m_mean) == (DAYS, None)
    assert got[5, 0].time is None and float(got[5, 0].temperature_2m_mean[0]) == 1.5
    others = landing.other_variables(parsed, VARIABLES).collect()
    assert [(r.batch_id, r.pos, r.variable, r["values"].toPython()) for r in others] == [(0, 0, "uv_index_max", [5, "x"])]
    assert sorted(r.batch_id for r in landing.unreadable(landed).collect()) == [1, 2]


def test_history_form_skips_days_without_mean(parsed, places):
    assert landing.complete_readings(parsed, places, VARIABLES).count() == 8


def test_pages(spark, tmp_path):
    pages = [{"results": [{"dep": "01", "libgeo": "Ain", "reg": "84", "reglib": "Rhône",
                           "annee": "2020", "nb_j_can": 3}]}, {"results": []},
             {"results": [{"dep": "02", "annee": "2021"}]}]
    (tmp_path / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
    got = landing.heat_record(landing.read_pages(spark, str(tmp_path)))
    assert rows(got) == sorted([("01", "Ain", "84", "Rhône", "2020", 3.0),
                                ("02", None, None, None, "2021", None)], key=repr)


def test_tagged_union(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, 3)], "x int, y int")
    got = landing.tagged_union({"Grippe": a, "Bronchiolite": b})
    assert rows(got.select("x", "y", "pathologie")) == [(1, None, "Grippe"),
                                                        (2, 3, "Bronchiolite")]


def batch(spark, items):
    return spark.createDataFrame(items, "time timestamp, nom_poi string, n int")


def order():
    return dedup.ascending(["n"])


def test_append_by_key_keeps_first_of_repeats_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "raw")
    old = batch(spark, [(datetime(2026, 8, 1), "1034", 1), (datetime(2026, 8, 1), "Belley", 2)])
    assert sinks.append(old, path)
    new = batch(spark, [(datetime(2026, 8, 1), "01034", 3), (datetime(2026, 8, 2), "01034", 5),
                        (datetime(2026, 8, 2), "01034", 4), (datetime(2026, 8, 1), "04070", 6),
                        (datetime(2026, 8, 2), None, 7), (datetime(2026, 8, 2), None, 8)])
    stored = spark.read.parquet(path)
    fresh = append.new_readings(new, stored, order(), date(2026, 8, 3))
    assert sorted(r.n for r in fresh.collect()) == [4, 6, 7]
    counts = append.ingest_counts(new, stored, date(2026, 8, 3)).first()
    assert tuple(counts) == (6, 3, 3)
    assert sinks.append(fresh, path)
    again = append.new_readings(new, spark.read.parquet(path), order(), date(2026, 8, 3))
    assert again.count() == 0 and not sinks.append(again, path)


def test_append_by_key_looks_back_a_bounded_time(spark):
    old = batch(spark, [(datetime(2026, 1, 1), "01034", 1)])
    assert append.new_readings(old, old, order(), date(2026, 8, 3), 60).count() == 1
    assert append.new_readings(old, old, order()).count() == 0


def test_append_by_hash_keeps_repeats(spark):
    old = batch(spark, [(datetime(2026, 8, 1), "Belley", 1)])
    new = batch(spark, [(datetime(2026, 8, 1), "Belley", 2), (datetime(2026, 8, 2), "Belley", 3),
                        (datetime(2026, 8, 2), "Belley", 4)])
    fresh = append.new_by_hash(new, old, date(2026, 8, 1), date(2026, 8, 23))
    assert sorted(r.n for r in fresh.collect()) == [3, 4]
    assert fresh.select("row_hash").distinct().count() == 1
    assert append.new_by_hash(new, new).count() == 0


def test_append_by_record_key_and_by_record_hash(spark):
    records = spark.createDataFrame(
        [("01", "2020", 3.0), ("01", "2020", 4.0), ("02", "2020", None), ("02", "2020", None)],
        "dep string, annee string, nb_j_can double")
    mapped = landing.load_records(records.select("dep", F.lit(None).cast("string").alias("libgeo"),
                                                 F.lit("84").alias("reg"), F.lit("R").alias("reglib"),
                                                 "annee", "nb_j_can"),
                                  mapper=landing.heat_record, key=["code_departement", "annee"])
    assert rows(mapped.select("code_departement", "nombre_jours")) == [("01", 3.0), ("02", None)]
    stored = mapped
    assert landing.load_records(mapped, stored, key=["code_departement", "annee"]).count() == 0
    hashed = landing.load_records(records)
    assert hashed.count() == 3 and hashed.select("record_hash").distinct().count() == 3
    assert landing.load_records(records, hashed).count() == 0


def test_append_shuffles_the_batch_once(spark, tmp_path):
    items = [(datetime(2026, 8, 1), "01034", i) for i in range(5)]
    batch(spark, items).write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a")).hint("merge")
    text = plan(append.new_readings(a, a.select("time", "nom_poi"), order()))
    assert "WindowGroupLimit" in text and text.count("hashpartitioning") <= 3


@pytest.mark.parametrize("missing, total, verdict", [
    (0, 4, "accepted"), (2, 4, "warning"), (51, 100, "refused"), (0, 0, "accepted")])
def test_gate(spark, missing, total, verdict):
    values = [(None if i < missing else 1.0,) for i in range(total)]
    df = spark.createDataFrame(values, "temperature_2m_max double")
    assert append.batch_gate(df).first().verdict == verdict


def test_missing_keys(spark):
    places = spark.createDataFrame([("01034",), ("75056",)], "code_insee string")
    stored = batch(spark, [(datetime(2026, 8, 2), "1034", 1), (datetime(2026, 8, 9), "1034", 1)])
    got = append.missing_keys(places, stored, date(2026, 8, 1), date(2026, 8, 2))
    assert rows(got) == [(date(2026, 8, 1), "01034"), (date(2026, 8, 1), "75056"),
                         (date(2026, 8, 2), "75056")]


def test_conform(spark):
    df = spark.createDataFrame([("12.5", "1034", "?")],
                               "temperature_2m_max string, nom_poi string, inconnu string")
    got = sinks.conform(df, schemas.RAW_WEATHER)
    assert got.schema.names == schemas.RAW_WEATHER.names
    assert got.first().temperature_2m_max == 12.5 and got.first().ville is None


def test_append_json_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows_in = batch(spark, [(datetime(2026, 8, 1), "1034", 1)])
    assert sinks.append(rows_in, path, fmt="json") and sinks.append(rows_in, path, fmt="json")
    assert spark.read.schema(rows_in.schema).json(path).count() == 2


def fact(spark, items):
    return spark.createDataFrame(items, "date date, code_insee string, t double")


def test_month_partitions_prune_and_replace(spark, tmp_path):
    path = str(tmp_path / "fact")
    sinks.rebuild_by_month(fact(spark, [(date(2026, m, 1), "01034", float(m))
                                        for m in range(1, 9)]), path)
    table = spark.read.parquet(path)
    kept = between_days(table, date(2026, 3, 1), date(2026, 4, 30))
    text = plan(kept)
    assert "date_month" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert kept.count() == 2
    files = {f for f in after_files(path) if "date_month=2026-03" not in f}
    changed = [(date(2026, 3, 5), "75056", 99.0), (date(2026, 3, 1), "01034", 98.0)]
    sinks.upsert_months(fact(spark, changed), path, ["date", "code_insee"])
    after = spark.read.parquet(path)
    assert after.count() == 9 and after.where("t >= 98").count() == 2
    assert after.where("date = date'2026-03-01'").count() == 1
    assert {f for f in after_files(path) if "date_month=2026-03" not in f} == files


def after_files(path):
    return {str(f) for f in Path(path).rglob("*.parquet")}


def test_delta(spark):
    stored = fact(spark, [(date(2026, 3, 1), "01034", 1.0)])
    fresh = fact(spark, [(date(2026, 3, 1), "01034", 2.0), (date(2026, 4, 2), "01034", 3.0)])
    got = sinks.delta(fresh, stored, ["date", "code_insee"])
    assert rows(got.select("t", "date_month")) == [(3.0, date(2026, 4, 1))]


def test_run_logs(spark, tmp_path):
    steps = {"fetch": {"step": "fetch", "emissions_kg_co2": 0.25, "duration_seconds": 2.0,
                       "status": "success"},
             "load": {"step": "load", "emissions_kg_co2": 0.5, "duration_seconds": 1.0,
                      "status": "success"}}
    (tmp_path / "steps.json").write_text(json.dumps(steps, indent=2))
    read = runlog.read_steps(spark, str(tmp_path / "steps.json"))
    assert rows(runs.step_totals(read)) == [("TOTAL", 0.75, 3.0), ("fetch", 0.25, 2.0),
                                            ("load", 0.5, 1.0)]
    names = schemas.EMISSIONS_LOG.names
    assert len(names) == 38
    line = {"timestamp": "2026-09-01T11:52:02", "duration": "0.77", "cpu_model": "M4"}
    (tmp_path / "log.csv").write_text(
        ",".join(names) + "\n" + ",".join(line.get(n, "") for n in names) + "\n")
    got = runlog.read_emissions(spark, str(tmp_path / "log.csv")).first()
    assert got.duration == 0.77 and got.timestamp == datetime(2026, 9, 1, 11, 52, 2)


def test_inventory_counts_bytes(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    got = runs.inventory({("raw", "nation"): nation, ("raw", "orders"): orders}).collect()
    assert [(r.table, r.lignes, r.colonnes) for r in got] == [("orders", orders.count(), 6),
                                                              ("nation", 25, 3)]
    assert got[1].taille_mo == 0.0
