"""Nothing is lost without a word: landed files, reports, infinite values, touched months."""

import json
import math
from datetime import date, datetime

import pytest

from heatmart import job
from heatmart.operators import quality, scale, stats
from heatmart.plans import ingest
from heatmart.sources import landing
from heatmart.streaming import incremental

BODY = {"daily": {"time": ["2026-08-01"], "temperature_2m_max": [31.0], "temperature_2m_mean": [25.0]}}


def landed(spark, bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "batch_id long, body string")


def listed(spark, n):
    return spark.createDataFrame([(i, 0, f"7505{i}", "V", 1.0, 2.0, "75") for i in range(n)],
                                 "batch_id long, pos int, nom_poi string, ville string, latitude_poi double, "
                                 "longitude_poi double, numero_departement string")


def test_unreadable_payloads_and_unlisted_locations_refuse_the_run(spark, tmp_path):
    good = json.dumps(BODY)
    for bodies, lost in (([good, good[:-20]], (1, 0)), ([good, None], (1, 0)), ([good] * 3, (0, 1))):
        done = ingest.daily_weather(landed(spark, bodies), listed(spark, 2), f"{tmp_path}/raw", date(2026, 8, 5))
        assert (done.verdict, done.unreadable, done.unmatched) == ("refused", *lost)
    done = ingest.daily_weather(landed(spark, [good, good[:-20]]), listed(spark, 2), f"{tmp_path}/raw", date(2026, 8, 5), tolerated=1)
    assert (done.verdict, done.inserted, done.unreadable) == ("accepted", 1, 1)


def test_truncated_page_raises_and_stops_only_its_feed(spark, tmp_path):
    page = '{"results": [{"annee": "2020"}]}'
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p.json").write_text(page + "\n" + page[:-5] + "\n")
    with pytest.raises(Exception, match="unreadable page"):
        landing.read_pages(spark, f"{tmp_path}/pages").collect()
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no parquet")
    records = spark.createDataFrame([("a", 1)], "k string, v int")
    feeds = {"broken": ingest.Feed(spark.read.schema("k string, v int").parquet(f"{tmp_path}/broken"), f"{tmp_path}/t1", key=["k"]),
             "good": ingest.Feed(records, f"{tmp_path}/t2", key=["k"])}
    report = ingest.health_feeds(feeds)
    assert set(report.failed) == {"broken"} and report.done["good"].inserted == 1


def test_percentiles_of_infinite_huge_and_tiny_values(spark):
    values = [-math.inf, -1.7e308, -1.0, 0.0, 5e-324, 1.0, 2.0, 1.7e308, math.inf]
    got = stats.percentiles(spark.createDataFrame([(v,) for v in values], "v double"), ["v"], [i / 8 for i in range(9)])
    assert [r.value for r in got.orderBy("share").collect()] == values
    assert stats.between(-1.7e308, 1.7e308, 0.5) == 0.0


def test_streams_list_only_touched_months(spark, tmp_path):
    rows = [(date(2026, m, 1), date(2026, m, 1), float(m)) for m in range(1, 7)]
    spark.createDataFrame(rows, "date date, date_month date, t double").write.partitionBy("date_month").parquet(f"{tmp_path}/fact")
    kept = incremental.in_months(spark.read.parquet(f"{tmp_path}/fact"), [date(2026, 2, 1), date(2026, 5, 1)])
    text = kept._jdf.queryExecution().executedPlan().toString()
    listed_months = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "date_month" in listed_months and kept.count() == 2


def test_coverage_has_one_rule_at_the_limit(spark):
    df = spark.createDataFrame([(str(i),) for i in range(350)], "code string")
    assert quality.low_coverage(df, "code", 350).count() == 1
    found = quality.run_checks("m", df, quality.Checks(more_than={"code": 350})).first()
    assert found.status == "fail"
    assert quality.run_checks("m", df, quality.Checks(more_than={"code": 349})).first().status == "pass"


def test_reports_state_how_many_rows_there_are(spark, monkeypatch, capsys):
    monkeypatch.setitem(job.REPORTS, "coverage", lambda t, o: spark.range(500))
    monkeypatch.setattr(job.build, "load", lambda *_: {})
    assert job.run(spark, job.parse(["report", "--root", "x", "--name", "coverage"])) == 0
    assert "first 100 of 500 rows" in capsys.readouterr().out


def test_stored_folder_without_files_is_no_first_load(spark, tmp_path):
    assert ingest.stored_table(spark, f"{tmp_path}/none") is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="infer schema|INFER"):
        ingest.stored_table(spark, f"{tmp_path}/empty")


def test_declared_checks_see_markers_strays_and_ranges(spark):
    fact = spark.createDataFrame([("a", -999.0), ("b", 20.0), ("z", 50.0), (None, 1.0)], "code_insee string, temperature_moyenne double")
    parent = spark.createDataFrame([("a",), ("b",)], "code_insee string")
    checks = quality.Checks(ranges={"temperature_moyenne": (-30.0, 45.0)}, no_sentinel=["temperature_moyenne"],
                            more_than={"code_insee": 3}, references={"code_insee": "parent"})
    found = {r.check: (r.violations, r.status) for r in quality.run_checks("fact", fact, checks, {"parent": parent}).collect()}
    assert found == {"range": (2, "fail"), "sentinel": (1, "fail"), "coverage": (1, "fail"), "relationship": (1, "fail")}
    assert quality.run_checks("p", parent, quality.Checks(references={"code_insee": "p"}), {"p": parent}).first().violations == 0


def test_intermediate_tables_go_with_their_block(spark):
    with scale.released():
        inner = scale.cut_lineage(spark.range(3))
        folder = inner.inputFiles()[0].rsplit("/", 1)[0]
        assert inner.count() == 3 and scale.exists(spark, folder)
    assert not scale.exists(spark, folder)
    with pytest.raises(ValueError), scale.released():
        folder = scale.cut_lineage(spark.range(3)).inputFiles()[0].rsplit("/", 1)[0]
        raise ValueError
    assert not scale.exists(spark, folder)
