"""Late and replaced readings: changes, monthly states, merges that break off, best readings of a stream."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import adapters
from heatmart import job, schemas
from heatmart.operators import analytics, dedup, health, presence, quality, states
from heatmart.plans import build, marts
from heatmart.sources import changes, versions
from heatmart.sources.sinks import conform, rebuild_by_month
from heatmart.streaming import incremental
from support import plan, rows

SMALL = "/root/testdata/sf0.001"
PANEL = ("date date, code_insee string, departement string, region string, temperature_moyenne double,"
         " temperature_maximale double, temperature_minimale double, humidite_moyenne double, precipitations_totales double")


def some_panel(spark, seed, n=300):
    r = random.Random(seed)
    def value():
        return r.choice([None, float("nan"), round(r.uniform(-5, 44), 2), 41.5, 35.0])
    return [(date(2019, 11, 1) + timedelta(days=r.randrange(400)), f"{r.randrange(40):05d}", r.choice(["Ain", "Aude", None]),
             r.choice(["R", None]), *[value() for _ in range(5)]) for _ in range(n)]


def frame(spark, items):
    return spark.createDataFrame(items, PANEL)


@pytest.mark.parametrize("seed", [1, 2])
def test_states_after_changes_equal_states_of_what_is_left(spark, seed):
    r = random.Random(seed)
    before = some_panel(spark, seed)
    gone, come = r.sample(before, 120), some_panel(spark, seed + 10, 60)
    left = list(before)
    for x in gone:
        left.remove(x)
    left += come
    signed = frame(spark, come).withColumn("sign", F.lit(1)).union(frame(spark, gone).withColumn("sign", F.lit(-1)))
    asked = []

    def recount(groups):
        asked.append(groups.count())
        return states.of_groups(frame(spark, left), groups)
    got = states.merged(states.states(frame(spark, before)), states.deltas(signed), recount)
    want = states.states(frame(spark, left))
    assert rows(got.select(*want.columns)) == rows(want)
    # only groups that lost their peak
    assert 0 < asked[0] < want.count()


def test_reports_of_states_equal_those_of_the_panel(spark):
    panel = frame(spark, [tuple(None if isinstance(v, float) and v != v else v for v in x) for x in some_panel(spark, 5)]).cache()
    table = states.states(panel)
    for mine, theirs in ((states.yearly_trend, analytics.yearly_trend), (states.heat_days_by_year, analytics.heat_days_by_year),
                         (states.heat_days_by_month, analytics.heat_days_by_month), (states.department_year, health.department_year),
                         (states.department_summer, health.department_summer)):
        want = theirs(panel)
        assert rows(mine(table).select(*want.columns)) == rows(want), mine.__name__
    for mine, theirs in zip(states.seasonality(table).collect(), analytics.seasonality(panel).collect()):
        assert tuple(mine) == pytest.approx(tuple(theirs))


def test_versions_outlive_a_broken_writer(spark, tmp_path):
    path = f"{tmp_path}/t"
    fail = F.udf(lambda i: 1 // 0 if i == 99 else i, "long")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    versions.publish(spark.range(3), path, "a")
    with pytest.raises(Exception, match="ZeroDivision"):
        versions.publish(spark.range(100).select(fail("id").alias("id")), path, "b")
    assert versions.read(spark, path).count() == 3 and versions.current(spark, path)[1] == "a"
    reader = versions.read(spark, path)
    # a version may be made from the one before, which stays for who reads it
    versions.publish(versions.read(spark, path).where("id > 0"), path, "c")
    assert versions.read(spark, path).count() == 2 and reader.count() == 3
    versions.publish(spark.range(7), path, "d")
    assert versions.read(spark, path).count() == 7 and len(list((tmp_path / "t").iterdir())) == 2


def test_presence_equals_counting_distinct(spark):
    r = random.Random(6)
    towns = ["x", "y", None] + [f"t{i}" for i in range(70_000)]
    items = [(r.choice([None, date(2020, 1, 1) + timedelta(days=r.randrange(50))]), f"{i % 40_000:05d}", towns[r.randrange(3) if i % 3 else i % 70_000],
              r.choice(["Ain", None]), r.choice(["R", "S", None])) for i in range(90_000)]
    panel = spark.createDataFrame(items, "date date, code_insee string, ville string, departement string, region string")
    places = presence.numbered_places(panel)
    assert places.count() == panel.select(*presence.PLACE).distinct().count()
    days = presence.presence(panel, places)
    half = panel.where("code_insee < '20000'"), panel.where("code_insee >= '20000'")
    both = presence.merged(*[presence.presence(h, places) for h in half])
    for table in (days.cache(), both.cache()):
        assert rows(presence.coverage(table, places)) == rows(quality.coverage(panel))
        assert rows(presence.key_uniqueness(table)) == rows(quality.key_uniqueness(panel))
        assert rows(presence.incomplete_days(table, 700)) == rows(quality.incomplete_days(panel, 700))
        assert rows(presence.continuity(table)) == rows(quality.continuity(panel))
    none = presence.presence(panel.where("false"), places)
    assert rows(presence.coverage(none, places)) == rows(quality.coverage(panel.where("false")))
    assert rows(presence.key_uniqueness(none)) == rows(quality.key_uniqueness(panel.where("false")))


def test_bitmaps_take_no_more_than_the_readings_they_stand_for(spark):
    full = [(date(2020, 1, 1), f"{i:05d}", f"t{i * 7919 % 6400}") for i in range(6400)]
    r = random.Random(3)
    few = [(date(2020, 2, 1) + timedelta(days=i % 50), *r.choice(full)[1:]) for i in range(400)]
    panel = spark.createDataFrame(full + few, "date date, code_insee string, ville string").selectExpr("*", "'Ain' as departement", "'R' as region")
    places = presence.numbered_places(panel)
    days = presence.presence(panel, places)
    # a day that has all places needs some words, one with few places no more than it has readings
    count = {x["date"]: x["count"] for x in days.groupBy("date").count().collect()}
    assert count.pop(date(2020, 1, 1)) < 6400 / 16 and sum(count.values()) <= 400
    assert {t for c, t in days.dtypes if c != "date"} == {"bigint"}
    for part in (days, presence.merged(days, days), presence.coverage(days, places), presence.key_uniqueness(days)):
        assert "SortAggregate" not in plan(part)


FACT = "date date, code_insee string, temperature_max double, temperature_ressentie_max double, n int"


def fact(spark, items):
    return spark.createDataFrame([(date(2020, *d), c, a, b, n) for d, c, a, b, n in items], FACT)


def test_best_changes_name_what_comes_and_goes(spark, tmp_path):
    keys, order = ["date", "code_insee"], dedup.best_order(["n"])
    stored = fact(spark, [((1, 1), "a", None, 1.0, 1), ((1, 2), "a", 3.0, 1.0, 1), ((2, 1), "b", 1.0, None, 5)])
    fresh = fact(spark, [((1, 1), "a", 9.0, 1.0, 2), ((1, 1), "a", None, 1.0, 0), ((1, 2), "a", 3.0, 1.0, 1), ((2, 1), "b", 1.0, None, 4),
                         ((3, 1), "c", 1.0, None, 4)])
    got = changes.best_changes(fresh, stored, keys, order).select("code_insee", F.month("date"), "n", "sign")
    assert rows(got) == sorted([("a", 1, 2, 1), ("a", 1, 1, -1), ("b", 2, 4, 1), ("b", 2, 5, -1), ("c", 3, 4, 1)], key=repr)
    rebuild_by_month(stored, f"{tmp_path}/t")
    changes.put(changes.best_changes(fresh, stored, keys, order), f"{tmp_path}/t", keys)
    want = dedup.best_reading(stored.unionByName(fresh), keys, ["n"])
    assert rows(spark.read.parquet(f"{tmp_path}/t").select(*want.columns)) == rows(want)


def test_rows_are_ranked_once_for_what_comes_and_goes(spark):
    keys, order = ["date", "code_insee"], dedup.best_order(["n"])
    stored = fact(spark, [((1, 1), "a", None, 1.0, 1), ((1, 2), "a", 3.0, 1.0, 1)])
    got = changes.best_changes(fact(spark, [((1, 1), "a", 9.0, 1.0, 2), ((1, 2), "a", None, 1.0, 0)]), stored, keys, order)
    assert rows(got.select("code_insee", "n", "sign")) == [("a", 1, -1), ("a", 2, 1)]
    assert "Window" not in plan(got)


class Broken(Exception):
    pass


def test_changes_that_broke_off_are_finished_once(spark, tmp_path):
    log, seen, fragile = f"{tmp_path}/log", [], [True]

    def first(df, tag):
        seen.append(("first", tag, df.count()))

    def second(df, tag):
        if fragile[0]:
            raise Broken
        seen.append(("second", tag, df.count()))
    with pytest.raises(Broken):
        changes.carry_out(spark, log, lambda: spark.range(5), [first, second])
    fragile[0] = False
    assert changes.carry_out(spark, log, lambda: spark.range(0), [first, second]) == 0
    tag = seen[0][1]
    assert seen == [("first", tag, 5), ("first", tag, 5), ("second", tag, 5)]
    assert versions.current(spark, log) is None


@pytest.fixture(scope="module")
def raw(spark):
    weather = conform(adapters.raw_weather(spark, SMALL), schemas.RAW_WEATHER)
    others = [adapters.raw_communes(spark, SMALL), adapters.raw_heat_health(spark, SMALL), adapters.raw_winter(spark, SMALL)]
    return weather, others


def test_a_merge_that_breaks_off_ends_as_a_full_build(spark, raw, tmp_path, monkeypatch, capsys):
    weather, others = raw
    early = F.col("sunshine_duration") < 20_000
    build.build(spark, build.Raw(weather, *others), f"{tmp_path}/full")
    build.build(spark, build.Raw(weather.where(early), *others), f"{tmp_path}/late")
    late = weather.where(~early | (F.col("sunshine_duration") < 5000))
    conform(late, schemas.RAW_WEATHER).write.parquet(f"{tmp_path}/raw")
    whole = states.merged
    monkeypatch.setattr(states, "merged", lambda *a: (_ for _ in ()).throw(Broken()))
    with pytest.raises(Broken):
        build.merge(spark, late, f"{tmp_path}/late")
    monkeypatch.setattr(states, "merged", whole)
    argv = ["merge", "--weather", f"{tmp_path}/raw", "--root", f"{tmp_path}/late"]
    assert job.run(spark, job.parse(argv)) == 0
    for name, table in build.load(spark, f"{tmp_path}/full").items():
        audit = [c for c in table.columns if c in schemas.AUDIT_COLUMNS]
        want, got = table.drop(*audit), build.load(spark, f"{tmp_path}/late")[name].drop(*audit)
        assert rows(got.select(*want.columns)) == rows(want), name
    want = build.monthly_states(spark, f"{tmp_path}/full")
    assert rows(build.monthly_states(spark, f"{tmp_path}/late").select(*want.columns)) == rows(want)
    # nothing new: no month is written again
    files = {(p, p.stat().st_mtime_ns) for p in (tmp_path / "late" / "fct_daily").glob("*/*.parquet")}
    build.merge(spark, late, f"{tmp_path}/late")
    assert {(p, p.stat().st_mtime_ns) for p in (tmp_path / "late" / "fct_daily").glob("*/*.parquet")} == files
    out = f"{tmp_path}/r"
    job.run(spark, job.parse(["report", "--root", f"{tmp_path}/late", "--name", "heat_days_by_year", "--states", "--out", out]))
    panel = marts.wide(spark.read.parquet(f"{tmp_path}/full/fct_daily"), spark.read.parquet(f"{tmp_path}/full/stg_communes"))
    days, places = build.daily_presence(spark, f"{tmp_path}/late")
    assert rows(presence.coverage(days, places)) == rows(quality.coverage(panel))
    assert rows(presence.incomplete_days(days, 3)) == rows(quality.incomplete_days(panel, 3))
    for part in (presence.coverage(days, places), presence.key_uniqueness(days), presence.incomplete_days(days)):
        assert "Expand" not in plan(part)
    assert rows(spark.read.parquet(out)) == rows(analytics.heat_days_by_year(panel))


READ = "time timestamp, nom_poi string, temperature_max double, temperature_ressentie_max double, n int"


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_best_readings_of_a_stream_in_any_order(spark, tmp_path, order):
    r = random.Random(4)
    items = [(datetime(2026, 7, 25) + timedelta(days=r.randrange(10), hours=r.randrange(24)), str(1000 + r.randrange(6)),
              r.choice([None, 29.0, 33.0, 36.0]), r.choice([None, 30.0]), i) for i in range(240)]
    items += [(None, "1000", 50.0, 50.0, 900), (datetime(2026, 7, 26), None, 50.0, 50.0, 901)]
    names = ["date", "code_insee", "temperature_max", "temperature_ressentie_max", "n"]
    whole = spark.createDataFrame(items, READ).where("time is not null and nom_poi is not null").selectExpr(
        "to_date(time) as date", "lpad(nom_poi, 5, '0') as code_insee", *names[2:])
    # what is stored already takes part
    stored = spark.createDataFrame([(date(2026, 7, 26), "01000", None, 30.0, -1), (date(2026, 7, 27), "01001", 36.0, 30.0, -1)], FACT)
    stored = stored.selectExpr("date", "code_insee", "timestamp(date) as time", "code_insee as nom_poi", *names[2:])
    rebuild_by_month(stored, f"{tmp_path}/fact")
    for part in order:
        spark.createDataFrame(items[part::3], READ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(READ).parquet(f"{tmp_path}/in")
        incremental.follow_best(stream, f"{tmp_path}/fact", f"{tmp_path}/report", f"{tmp_path}/state", ["n"]).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/fact")
    want = dedup.best_reading(whole.unionByName(stored.select(*names)), names[:2], ["n"])
    assert rows(got.select(*names)) == rows(want.select(*names))
    report = versions.read(spark, f"{tmp_path}/report")
    counted = got.groupBy("date_month").agg(F.count("*"), *[F.count_if(F.col("temperature_max") > t) for t in (30, 35, 40)])
    assert rows(report.select("date_month", "lignes", "jours_sup_30", "jours_sup_35", "jours_sup_40")) == rows(counted)
