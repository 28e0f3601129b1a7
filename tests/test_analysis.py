"""Quality, statistics, health and window operators on small frames."""

import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from heatmart.operators import analytics, dedup, health, quality, stats
from support import plan, rows


def one_column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def linear(values, share):
    ordered = sorted(values)
    at = share * (len(ordered) - 1)
    low = int(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0] * 10, [1e-9 * i for i in range(50)] + [1e9],
    [random.Random(7).gauss(0, 1) for _ in range(999)],
    [0.0] * 500 + [random.Random(3).random() for _ in range(500)]])
@pytest.mark.parametrize("fan_out", [2, 4096])
def test_percentiles_are_exact(spark, values, fan_out):
    df = one_column(spark, [*values, None, float("nan")])
    shares = [0.0, 0.25, 0.5, 0.9, 1.0] if fan_out > 2 else [0.5]
    got = {r.share: r.value for r in stats.percentiles(df, ["v"], shares, fan_out).collect()}
    assert got == pytest.approx({s: linear(values, s) for s in shares}, rel=1e-12, abs=1e-15)


def test_percentiles_of_many_values_store_few(spark, monkeypatch):
    df = spark.range(200_000).selectExpr(
        "double((id * 7919) % 200000) / 7 as a", "if(id % 3 = 0, null, double(id % 5)) as b",
        "case when id < 90000 then double('-infinity') when id < 150000 then 1.5D else double('infinity') end as c")
    kept = []
    whole = stats.cut_lineage
    monkeypatch.setattr(stats, "cut_lineage", lambda d: kept.append(whole(d)) or kept[-1])
    got = {(r.variable, r.share): r.value for r in stats.percentiles(df, ["a", "b", "c"], [0.25, 0.5, 0.999], accuracy=1000).collect()}
    for s in (0.25, 0.5, 0.999):
        assert got["a", s] == pytest.approx(linear([i / 7 for i in range(200_000)], s), rel=1e-12)
    assert [got["b", s] for s in (0.25, 0.5, 0.999)] == [1.0, 2.0, 4.0]
    assert [got["c", s] for s in (0.25, 0.5, 0.999)] == [float("-inf"), 1.5, float("inf")]
    assert len(kept) == 1 and kept[0].where("value is not null").count() < 5000


def test_percentiles_survive_sketches_that_miss(spark, monkeypatch):
    df = one_column(spark, [float(i) for i in range(500)])
    monkeypatch.setattr(stats.F, "percentile_approx", lambda v, around, accuracy: F.array(*[F.max(F.lit(7.0)) for _ in around]))
    got = {r.share: r.value for r in stats.percentiles(df, ["v"], [0.25, 0.5]).collect()}
    assert got == {0.25: 124.75, 0.5: 249.5}


def test_percentiles_of_nothing(spark):
    assert stats.percentiles(one_column(spark, [None]), ["v"], [0.5]).first().value is None


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i), 4.0) for i in range(61)], "a double, b double")
    got = stats.histograms(df, ["a", "b"])
    a = {r.bin: r.n for r in got.where("variable = 'a'").collect()}
    b = {r.bin: r.n for r in got.where("variable = 'b'").collect()}
    assert len(a) == len(b) == 60 and a[60] == 2 and all(a[i] == 1 for i in range(1, 60))
    assert b[31] == 61 and sum(b.values()) == 61


def test_correlation_matrix_handles_degenerate_columns(spark):
    df = spark.createDataFrame(
        [(float(i), 2.0 * i + 1, 3.0, None, float("nan") if i == 2 else -float(i))
         for i in range(5)], "a double, b double, c double, d double, e double")
    got = {(r.variable_1, r.variable_2): r.r
           for r in stats.correlation_matrix(df, ["a", "b", "c", "d", "e"]).collect()}
    assert len(got) == 25
    assert got["a", "b"] == got["b", "a"] == pytest.approx(1.0) and got["a", "a"] == 1.0
    assert got["a", "e"] == pytest.approx(-1.0)
    assert got["c", "c"] is None and got["a", "c"] is None and got["d", "a"] is None


def test_correlations_by_pattern_of_missing_values(spark):
    r = random.Random(11)
    cells = [[None if r.random() < 0.3 else base + r.gauss(0, 1) for base in (0.0, 1e6, -3e8)] for _ in range(400)]
    cells = [(x, None if x is None or y is None else y + x, z) for x, y, z in cells]
    df = spark.createDataFrame(cells, "a double, b double, c double")
    matrix = stats.correlation_matrix(df, ["a", "b", "c"])
    got = {(x.variable_1, x.variable_2): x.r for x in matrix.collect()}
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            both = [(c[i], c[j]) for c in cells if c[i] is not None and c[j] is not None]
            assert got[x, y] == pytest.approx(statistics.correlation(*zip(*both)), abs=1e-9)
    assert got["a", "b"] > 0.5


PANEL = "date date, departement string, region string, ville string, code_insee string," \
        " temperature_moyenne double, temperature_minimale double, temperature_maximale double," \
        " humidite_moyenne double, precipitations_totales double"


def panel(spark, items):
    return spark.createDataFrame(items, PANEL)


def reading(day, dep="Ain", town="Belley", mean=20.0, low=10.0, high=30.0):
    return (day, dep, "R", town, "01034", mean, low, high, 50.0, 1.0)


def test_weather_health_equals_joining_both_sides(spark):
    df = panel(spark, [reading(date(2020, m, 1), dep, high=25.0 + m)
                       for m in (1, 6, 7, 9, 12) for dep in ("Ain", "Aude")]
               + [reading(date(2021, 1, 1), "Ain"), reading(date(2020, 7, 1), None)])
    years = spark.createDataFrame([(date(2020, 1, 1), "Ain", 3.0), (date(2021, 1, 1), "Ain", 4.0),
                                   (date(2020, 1, 1), "Gers", 1.0)],
                                  "annee date, departement_nom string, nb_jours_canicule double")
    both = health.annual_with_summer(health.department_year(df), health.department_summer(df))
    one = health.weather_health(df, years)
    assert rows(one) == rows(health.with_health(both, years).select(*one.columns))
    assert [(r.annee, r.departement) for r in one.collect()] == [(2020, "Ain")]


@pytest.mark.parametrize("left, right", [
    (["a", "b"], ["b", "c"]), (["a", None], ["b"]), (["a"], ["b", None]), ([None, "a"], []),
    ([], ["a"]), ([None], [None])])
def test_key_gaps_follow_not_in(spark, left, right):
    a = spark.createDataFrame([(v,) for v in left], "k string")
    b = spark.createDataFrame([(v,) for v in right], "k string")
    a.createOrReplaceTempView("ours"), b.createOrReplaceTempView("theirs")
    expected = spark.sql("""
        select 'l' as source, k as nom from ours where k not in (select k from theirs)
        union all select 'r', k from theirs where k not in (select k from ours)""")
    got = health.key_gaps(a, b, "k", "k", ("l", "r"))
    assert rows(got) == rows(expected)
    assert "NestedLoop" not in plan(got)


def test_key_coverage(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,), ("x",)], "k string")
    b = spark.createDataFrame([("x",), (None,)], "k string")
    assert tuple(health.key_coverage(a, b, "k", "k").first()) == (3, 2, 1)


def test_heat_waves_need_three_complete_days(spark):
    days = [1, 2, 3, 5, 6, 7, 8]
    df = panel(spark, [reading(date(2020, 7, d), low=20.0, high=36.0) for d in days])
    limits = spark.createDataFrame([("Ain", 19.0, 35.0)],
                                   "departement string, seuil_min double, seuil_max double")
    got = analytics.heat_waves(df, limits)
    assert sorted(r.date.day for r in got.collect()) == [3, 7, 8]


def test_warmest_and_coolest_settle_ties_by_name(spark):
    df = spark.createDataFrame([("c", "r", 1.0), ("a", "r", 1.0), ("b", "r", 1.0), ("d", "r", 2.0)],
                               "departement string, region string, temp_moyenne double")
    got = analytics.warmest_and_coolest(df, 2)
    assert rows(got.select("cote", "departement")) == [("chaud", "a"), ("chaud", "d"),
                                                       ("frais", "a"), ("frais", "b")]


def test_run_checks(spark):
    df = panel(spark, [reading(date(2020, 1, 1)), reading(date(2020, 1, 1), mean=-999.0),
                       reading(None, town=None)])
    checks = quality.Checks(not_null=["date", "ville"], unique=[("date", "code_insee")],
                            ranges={"temperature_moyenne": (-30.0, 45.0)},
                            no_sentinel=["temperature_moyenne"], more_than={"code_insee": 1})
    got = {(r.column, r.check): (r.violations, r.status)
           for r in quality.run_checks("panel", df, checks).collect()}
    assert got == {("date", "not_null"): (1, "fail"), ("ville", "not_null"): (1, "fail"),
                   ("temperature_moyenne", "range"): (1, "fail"),
                   ("temperature_moyenne", "sentinel"): (1, "fail"),
                   ("code_insee", "coverage"): (1, "fail"),
                   ("date, code_insee", "unique"): (1, "fail")}


def test_violating_rows(spark):
    df = panel(spark, [reading(date(2020, 1, 1)), reading(date(2020, 1, 1), town=None, mean=99.0)])
    assert quality.null_rows(df, ["ville"]).count() == 1
    assert quality.repeated_keys(df, ["date", "code_insee"]).first().n == 2
    assert quality.repeated_keys(df, ["date", "ville"]).count() == 0
    assert quality.rows_out_of_range(df, "temperature_moyenne", -30, 45).count() == 1
    parent = spark.createDataFrame([("75056",)], "code_insee string")
    assert rows(quality.orphans(df, parent, "code_insee")) == [("01034", 2)]
    assert quality.low_coverage(df, "code_insee", 350).count() == 1
    assert quality.low_coverage(df, "code_insee", 0).count() == 0


def test_name_variants(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", "a"), ("2", "c"), ("2", None)],
                               "code_insee string, ville string")
    assert rows(quality.name_variants(df)) == [("1", 2, "a | b")]


def test_hot_key_shrinks_before_the_shuffle(spark):
    df = spark.range(10000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v").repartition(8)
    got = dedup.first_per_key(df, ["k"], dedup.ascending(["v"]))
    assert got.where("k = 0").first().v == 0 and got.count() == 6667
    assert plan(got).count("WindowGroupLimit") == 2


def test_statistics_agree_with_python(spark):
    rng = random.Random(1)
    values = [rng.gauss(10, 3) for _ in range(200)]
    df = panel(spark, [reading(date(2020, 1, 1), mean=v) for v in values])
    got = stats.summary(df, ["temperature_moyenne"]).where("variable = 'temperature_moyenne'").first()
    assert got["count"] == 200 and got["mean"] == round(statistics.fmean(values), 2)
    assert got["std"] == round(statistics.stdev(values), 2)


def test_trend_over_complete_years(spark):
    yearly = spark.createDataFrame([(2000 + i, 10 + 0.03 * i) for i in range(10)] + [(2026, 99.0)],
                                   "annee int, temp_moyenne_annuelle double")
    assert analytics.linear_trend(yearly, 2026).first().par_decennie == pytest.approx(0.3)


def test_analyses_ignore_partitioning(spark, sf_dir):
    from checks.adapters import daily_panel
    df = daily_panel(spark, sf_dir)
    mixed = df.repartition(7, F.xxhash64("code_insee", "date"))
    for report in (analytics.yearly_trend, analytics.heat_days_by_year, quality.coverage,
                   health.department_year):
        assert rows(report(df)) == rows(report(mixed))


def test_enrichment_by_code_then_by_name(spark):
    communes = spark.createDataFrame([("Saint-Denis", "11"), ("SAINT DENIS", "22"), ("Belley", "1"), ("Nulle", None), ("Loin", "77")],
                                     "ville string, numero_departement string")
    years = spark.createDataFrame([(date(2020, 1, 1), "01", 3.0), (date(2020, 1, 1), "11", 4.0), (date(2020, 1, 1), "22", 5.0),
                                   (date(2021, 1, 1), "2A", 6.0), (date(2020, 1, 1), None, 7.0)],
                                  "annee date, departement_code string, nb_jours_canicule double")
    d = date(2020, 7, 1)
    readings = spark.createDataFrame(
        [(d, "a", "Saint-Denis", "1", 30.0, None, 1), (d, "b", "saint denis", "99", 30.0, None, 2), (d, "c", "Belley", None, 30.0, None, 3),
         (d, "d", "Nulle", None, 30.0, None, 4), (d, "e", None, None, 30.0, None, 5), (d, "f", "Loin", "77", 30.0, None, 6),
         (d, "g", "Belley", "2A", 30.0, None, 7), (d, "a", "Belley", "22", None, None, 0)],
        "date date, code_insee string, ville string, numero_departement string, temperature_max double,"
        " temperature_ressentie_max double, n int")
    got = health.enriched(readings, communes, years, ["n"])
    assert rows(got.select("code_insee", "n", "departement_code", "nb_jours_canicule")) == [
        ("a", 1, "01", 3.0), ("b", 2, "11", 4.0), ("c", 3, "01", 3.0), ("d", 4, None, None), ("e", 5, None, None),
        ("f", 6, None, None), ("g", 7, "2A", None)]
