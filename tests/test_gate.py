"""Checks answered while a table is written."""

import pytest
from pyspark.sql import functions as F

from checks import adapters
from heatmart.operators import gate, quality
from heatmart.plans import build
from heatmart.sources.sinks import rebuild_by_month
from support import rows

CHECKS = quality.Checks(
    not_null=["k", "v"], unique=[("k",)], ranges={"v": (0.0, 10.0)}, no_sentinel=["v"],
    more_than={"k": 3}, references={"k": "parent"})
SHAPE = "k string, v double, date date"


@pytest.fixture()
def parent(spark):
    return spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")


def written(spark, tmp_path, data, parent, checks=CHECKS, **other):
    df = spark.createDataFrame(data, SHAPE)
    got = gate.write_checked(df, "m", checks, f"{tmp_path}/t", f"{tmp_path}/q", models={"parent": parent}, **other)
    assert rows(got) == rows(quality.run_checks("m", df, checks, {"parent": parent}))
    # as text: NaN is not equal to itself
    assert repr(rows(spark.read.parquet(f"{tmp_path}/t").select("k", "v"))) == repr(rows(df.select("k", "v")))
    return got


def test_same_answers_as_reading_again(spark, tmp_path, parent):
    data = [("a", 1.0, None), ("a", None, None), (None, -999.0, None), ("b", 11.0, None), ("x", float("nan"), None), (None, None, None)]
    written(spark, tmp_path, data, parent)
    aside = spark.read.parquet(f"{tmp_path}/q").select("k", "reasons")
    assert rows(aside) == rows(spark.createDataFrame([
        ("a", ["v not_null"]), (None, ["k not_null", "v range", "v sentinel"]), ("b", ["v range"]),
        ("x", ["v range"]), (None, ["k not_null", "v not_null"])], "k string, reasons array<string>"))


def test_clean_and_empty_tables_leave_nothing_aside(spark, tmp_path, parent):
    written(spark, tmp_path, [("a", None, None)], parent)
    assert (tmp_path / "q").exists()
    clean = [(k, 1.0, None) for k in "abcd"]
    assert all(r.status == "pass" for r in written(spark, tmp_path, clean, parent).collect())
    assert not (tmp_path / "q").exists()
    empty = {(r["column"], r.check): r.violations for r in written(spark, tmp_path, [], parent).collect()}
    assert empty["k", "coverage"] == 1 and sum(empty.values()) == 1


def test_by_month_and_without_checks(spark, tmp_path, parent):
    days = spark.sql("select date'2026-01-31' + x as d from (select explode(array(0, 1)) as x)").collect()
    written(spark, tmp_path, [("a", 20.0, days[0].d), ("b", 2.0, days[1].d)], parent, write=rebuild_by_month)
    assert spark.read.parquet(f"{tmp_path}/t").select("date_month").distinct().count() == 2
    assert written(spark, tmp_path, [("a", None, None)], parent, quality.Checks(unique=[("k",)])).count() == 1


def test_values_observed_never_exceed_the_distinct_ones(spark):
    seen = spark.range(200_000).select((F.col("id") % 500).alias("k")).agg(gate._at_least("k").alias("n")).first().n
    assert 480 <= seen <= 500
    assert spark.createDataFrame([(None,)], "k string").agg(gate._at_least("k")).first()[0] == 0


def test_checked_build_answers_what_check_reads(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    raw = build.Raw(adapters.raw_weather(spark, d), adapters.raw_communes(spark, d),
                    adapters.raw_heat_health(spark, d), adapters.raw_winter(spark, d))
    stored = build.build(spark, raw, str(tmp_path), checked=True)
    assert rows(build.answered(spark, str(tmp_path))) == rows(build.check(stored))
