"""Whole runs: ingestion, the command line, and skewed input."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from heatmart import job, schemas
from heatmart.operators import resolve, scale
from heatmart.plans import ingest
from heatmart.sources import landing
from support import rows

DAYS = ["2026-08-20", "2026-08-21"]
AS_OF = date(2026, 9, 1)


def landed(spark, *payloads):
    return spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)],
                                 "batch_id long, body string")


def payload(maxima, means=(20.0, 21.0)):
    return {"daily": {"time": DAYS, "temperature_2m_max": maxima,
                      "temperature_2m_mean": list(means)}}


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(
        [(b, 0, f"0{b}034", f"Ville {b}", 45.0, 5.0, "01") for b in range(3)],
        "batch_id long, pos int, nom_poi string, ville string, latitude_poi double,"
        " longitude_poi double, numero_departement string")


def test_daily_run_is_idempotent_and_gated(spark, places, tmp_path):
    path = str(tmp_path / "raw")
    first = ingest.daily_weather(landed(spark, payload([30.0, 31.0])), places, path, AS_OF)
    assert (first.received, first.inserted, first.verdict) == (2, 2, "accepted")
    both = landed(spark, payload([30.0, 31.0]), payload([33.0, None]))
    second = ingest.daily_weather(both, places, path, AS_OF)
    assert (second.received, second.inserted, second.skipped, second.verdict) == (
        4, 2, 2, "warning")
    third = ingest.daily_weather(both, places, path, AS_OF)
    assert (third.inserted, third.verdict) == (0, "accepted")
    empty = landed(spark, payload([]), payload([]), payload([]))
    refused = ingest.daily_weather(empty, places, path, AS_OF)
    assert (refused.inserted, refused.verdict) == (0, "refused")
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and stored.schema.names == schemas.RAW_WEATHER.names


def test_history_run(spark, places, tmp_path):
    path = str(tmp_path / "raw")
    body = landed(spark, payload([30.0], (20.0, None)), payload([30.0, 31.0]))
    run = lambda: ingest.history_weather(body, places, path, date(2026, 8, 1), date(2026, 8, 31))
    assert (run().inserted, run().inserted) == (3, 0)
    stored = spark.read.parquet(path)
    assert stored.where("row_hash is null or insere_a is null").count() == 0


def test_health_feeds_go_on_after_a_failure(spark, tmp_path):
    records = spark.createDataFrame([("01", "Ain", "84", "R", "2020", 3.0)] * 2,
                                    schemas.HEALTH_RECORD)
    feeds = {"broken": ingest.Feed(records, f"{tmp_path}/a", key=["absent"]),
             "heat": ingest.Feed(records, f"{tmp_path}/b", landing.heat_record,
                                 ["code_departement", "annee"]),
             "winter": ingest.Feed(records, f"{tmp_path}/c")}
    report = ingest.health_feeds(feeds)
    assert set(report.failed) == {"broken"}
    assert {n: o.inserted for n, o in report.done.items()} == {"heat": 1, "winter": 1}
    again = ingest.health_feeds(feeds)
    assert {n: o.inserted for n, o in again.done.items()} == {"heat": 0, "winter": 0}


def test_command_line(spark, tmp_path, capsys):
    from checks import adapters
    from heatmart.sources.sinks import conform
    d = "/root/testdata/sf0.001"
    kept = {p.name for p in Path(scale.shared_folder(spark).removeprefix("file:")).glob("cut-*")}
    shapes = {"weather": (adapters.raw_weather, schemas.RAW_WEATHER),
              "communes": (adapters.raw_communes, schemas.RAW_COMMUNES),
              "heat": (adapters.raw_heat_health, schemas.RAW_HEAT_HEALTH),
              "winter": (adapters.raw_winter, schemas.RAW_WINTER)}
    argv = ["build", "--root", f"{tmp_path}/t"]
    for name, (make, schema) in shapes.items():
        conform(make(spark, d), schema).write.parquet(f"{tmp_path}/{name}")
        argv += [f"--{name}", f"{tmp_path}/{name}"]
    assert job.run(spark, job.parse(argv)) == 0
    check = ["check", "--root", f"{tmp_path}/t", "--communes-over"]
    codes = spark.read.parquet(f"{tmp_path}/t/fct_daily").select("code_insee").distinct().count()
    assert job.run(spark, job.parse([*check, str(codes - 1)])) == 0
    said = capsys.readouterr().out
    assert "pass dim_date.date unique: 0" in said
    assert "pass fct_daily.code_insee relationship: 0" in said
    assert job.run(spark, job.parse([*check, str(codes)])) == 1
    assert "fail fct_daily.code_insee coverage: 1" in capsys.readouterr().out
    def files(month):
        return {(p, p.stat().st_mtime_ns)
                for p in (tmp_path / "t" / "fct_daily").glob(f"date_month={month}*/*")}
    before, later = files("1997"), files("1999")
    fact = rows(spark.read.parquet(f"{tmp_path}/t/fct_daily").drop("inserted_at", "updated_at"))
    assert job.run(spark, job.parse([*argv, "--since", "1998-06-15"])) == 0
    assert before and later and files("1997") == before and not files("1999") & later
    assert rows(spark.read.parquet(f"{tmp_path}/t/fct_daily")
                .drop("inserted_at", "updated_at")) == fact
    shared = Path(scale.shared_folder(spark).removeprefix("file:"))
    assert job.run(spark, job.parse([*check, "0"])) == 0 and not {
        p.name for p in shared.glob("cut-*")} - kept
    for name in job.REPORTS:
        out = f"{tmp_path}/r/{name}"
        job.run(spark, job.parse(["report", "--root", f"{tmp_path}/t", "--name", name,
                                  "--out", out]))
    years = spark.read.parquet(f"{tmp_path}/r/heat_days_by_year")
    assert years.count() > 0


# ---- skew ---------------------------------------------------------------------


@pytest.fixture
def tight(spark):
    """Thresholds so small that test data counts as big and skewed."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
              "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
              "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_place_is_split_in_the_shuffle_join(spark, tight, tmp_path):
    communes = spark.range(200).selectExpr(
        "lpad(cast(id as string), 5, '0') as code_insee", "'Ville ' || id as ville",
        "'01' as numero_departement", "1.0D as latitude", "2.0D as longitude")
    hot = spark.range(60000).selectExpr(
        "id", "cast(if(id % 3 = 0, 7, id % 200) as string) as nom_poi",
        "cast(null as string) as ville", "sha2(cast(id as string), 256) as payload")
    hot.repartition(6).write.parquet(f"{tmp_path}/hot")
    got = resolve.resolve_places(spark.read.parquet(f"{tmp_path}/hot"), communes, 0)
    counts = {r.code_insee: r.n for r in got.groupBy("code_insee").agg(
        F.count("*").alias("n")).collect()}
    assert len(counts) == 200 and sum(counts.values()) == 60000 and counts["00007"] > 20000
    got.write.format("noop").mode("overwrite").save()
    got.count()
    final = got._jdf.queryExecution().executedPlan()
    got.collect()
    assert "skew=true" in final.toString()


def test_null_keys_are_spread(spark):
    df = spark.range(1000).select(
        scale.spread_nulls(F.lit(None).cast("string"), F.col("id")).alias("k"))
    assert df.distinct().count() == 1000 and df.where("k like 'a%'").count() == 0


def test_broadcast_depends_on_measured_size(spark):
    df = spark.range(100).selectExpr("cast(id as string) as s")
    table, figures = scale.stored_and_measured(df, small=F.count_if(F.col("s") < "2"))
    assert rows(table) == rows(df) and figures["small"] == 12
    assert figures["bytes"] >= 100 * 24
    assert scale.stored_and_measured(df.where("s = 'x'"))[1]["bytes"] == 0


def test_partition_numbers_follow_the_input():
    from heatmart.session import sized_for
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert [sized_for(b)[number] for b in (0, 10 ** 12, 10 ** 14)] == ["200", "3726", "372530"]


def test_hot_name_in_the_commune_list_is_split(spark, tight):
    communes = spark.range(30000).selectExpr(
        "lpad(cast(id as string), 5, '0') as code_insee",
        "if(id % 3 = 0, 'Sainte Foule', 'Ville ' || id) as ville",
        "cast(null as string) as numero_departement", "1.0D as latitude", "2.0D as longitude")
    readings = spark.range(3000).selectExpr(
        "case id when 0 then 'sainte-foule' when 1 then 'Nulle part' else 'VILLE ' || id end"
        " as nom_poi", "cast(null as string) as ville")
    got = resolve.match_places(readings, communes, 0)
    counts = got.groupBy("nom_poi").agg(F.count("*").alias("n"))
    assert counts.where("nom_poi = 'sainte-foule'").first().n == 10000
    assert counts.where("n = 1").count() == 1999 and counts.count() == 2000
