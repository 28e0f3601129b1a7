"""Column helpers against plain Python on hand-written values."""

import hashlib
import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from heatmart.functions import numeric, text
from heatmart.functions.dates import collection_window, is_weekend, month_label
from support import rows


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


def python_key(name):
    return "".join(c for c in unicodedata.normalize("NFD", name.upper())
                   if not unicodedata.category(c).startswith("M"))


NAMES = ["Digne-les-Bains", "Saint-Chely-d'Apcher", "Châlons-en-Champagne", "L’Haÿ-les-Roses",
         "Œuilly", "étampes", "Ñandú ça", "  ", "", "123 rue", "Ṩ ǖ"]


def test_region_key_is_nfd_without_marks(spark):
    assert apply(spark, text.region_key, NAMES) == [python_key(n) for n in NAMES]


def test_fold_name_keeps_letters_and_digits(spark):
    expected = ["".join(c for c in python_key(n) if c.isascii() and c.isalnum()) for n in NAMES]
    assert apply(spark, text.fold_name, NAMES) == expected


def test_fold_name_is_idempotent_and_null_safe(spark):
    once = apply(spark, text.fold_name, NAMES)
    assert apply(spark, text.fold_name, once) == once
    assert apply(spark, text.fold_name, [None]) == [None]


def test_every_accented_character_of_the_table(spark):
    composed, base = text._accent_table()
    got = spark.createDataFrame([(composed,)], "v string").select(
        text.strip_accents(F.col("v"))).first()[0]
    assert got == base and len(composed) > 1000


def test_trim_strips_unicode_space(spark):
    assert apply(spark, text.trim_space, ["\t a ", " b c\n", " "]) == ["a", "b c", ""]


@pytest.mark.parametrize("function, cases", [
    (text.staging_code, {"1034": "01034", "2A004": "2A004", "2a004": "2a004", "123456": "12345",
                         "2Bx": "2Bx", "": "00000", None: None}),
    (text.collector_code, {"1034": "01034", "2A004": "2A004", "2a004": "2A004",
                           "123456": "123456", " 7 ": "00007", "": None, "\t": None,
                           "2a04": "2a04", "abc": "abc", None: None}),
    (text.lookup_code, {"1034": "01034", "2A004": "2A004", "2a004": None, "1034\n": None,
                        "Paris": None, "123456": "12345", "": None, None: None}),
    (text.lookup_name, {"Digne-les-Bains": "DIGNELESBAINS", "1034": None, "2 rives": None,
                        "": "", "!": "", None: None}),
    (text.stored_code, {"1034": "01034", "Paris": "Paris", "2a004": "2a004", None: None}),
    (text.pad_department, {"5": "05", "75": "75", "971": "971", "2A": "2A", None: None}),
])
def test_codes(spark, function, cases):
    assert apply(spark, function, list(cases)) == list(cases.values())


def test_reading_hash(spark):
    df = spark.sql("select timestamp'2026-08-01 13:00:00' as t, 'Belley' as n")
    got = df.select(text.reading_hash(F.col("t"), F.col("n"))).first()[0]
    assert got == hashlib.sha256(b"2026-08-01 00:00:00_Belley").hexdigest()


def test_record_hash_ignores_column_order(spark):
    a = spark.createDataFrame([("x", None)], "p string, q string")
    one = a.select(text.record_hash(["p", "q"])).first()[0]
    two = a.select("q", "p").select(text.record_hash(["q", "p"])).first()[0]
    assert one == two == hashlib.md5(json.dumps({"p": "x"}, separators=(",", ":")).encode()
                                     ).hexdigest()


def test_round_half_away_from_zero(spark):
    values = [1.005, -0.125, 0.125, 2.675, 1e15 + 0.3, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(numeric.round_to(F.col("v"), 2)).collect()]
    assert got[:4] == [1.01, -0.13, 0.13, 2.68]
    assert got[4] == pytest.approx(1e15 + 0.3) and got[5] != got[5] and got[6] is None


@pytest.mark.parametrize("pairs, expected", [
    ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], 0.9979), ([(1.0, 1.0), (1.0, 2.0)], None),
    ([(None, 1.0), (2.0, None)], None), ([(1.0, 1.0)], None), ([], None),
    ([(1.0, 1.0), (2.0, 2.0), (float("nan"), 9.0)], 1.0)])
def test_pearson_never_raises(spark, pairs, expected):
    df = spark.createDataFrame(pairs, "x double, y double")
    got = df.agg(numeric.pearson(F.col("x"), F.col("y"))).first()[0]
    assert got is None if expected is None else got == pytest.approx(expected, abs=1e-3)


def test_calendar(spark):
    df = spark.sql("select explode(sequence(date'2026-08-01', date'2026-08-03')) as d")
    got = rows(df.select("d", month_label(F.col("d")), is_weekend(F.col("d"))))
    assert [r[1:] for r in got] == [("Août", True), ("Août", True), ("Août", False)]


def test_collection_window_is_eleven_days():
    from datetime import date
    first, last = collection_window(date(2026, 9, 1))
    assert (first, last) == (date(2026, 8, 17), date(2026, 8, 27)) and (last - first).days == 10
