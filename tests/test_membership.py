"""Bit sets of keys that thin out stored rows before the shuffle."""

import pytest
from pyspark.sql import functions as F

from heatmart.operators import append, dedup
from heatmart.operators.membership import key_bits, may_hold
from support import plan, rows


def keyed(spark, ids):
    return spark.createDataFrame([(f"day {i % 7}", f"code {i}") for i in ids], "a string, b string")


def test_every_held_key_stays_and_few_strangers(spark):
    keys = keyed(spark, range(0, 4000, 2)).unionByName(keyed(spark, [0, 0, 2]))
    kept = {b for _, b in may_hold(keyed(spark, range(40_000)), keys, ["a", "b"], 1 << 10).collect()}
    held = {f"code {i}" for i in range(0, 4000, 2)}
    assert held <= kept
    assert len(kept - held) < 400
    crowded = may_hold(keyed(spark, range(4000)), keys, ["a", "b"], 1)
    assert crowded.count() == 4000  # one word for all keys lets everything through


def test_no_keys_missing_parts_and_sizes(spark):
    none = keyed(spark, [1]).where("false")
    stored = spark.createDataFrame([(None, "x"), ("d", None), (None, None), ("d", "x")], "a string, b string")
    assert may_hold(stored, none, ["a", "b"], 1).count() == 0
    assert rows(may_hold(stored, stored.where("b is null"), ["a", "b"])) == rows(stored.where("b is null"))
    assert may_hold(none, stored, ["a", "b"]).count() == 0
    bits = key_bits(stored, ["a", "b"], 2).collect()
    assert 1 <= len(bits) <= 2 and 2 <= sum(bin(r[1] & (1 << 64) - 1).count("1") for r in bits) <= 16
    for words in (0, 3, 100, 1 << 21):
        with pytest.raises(ValueError):
            key_bits(stored, ["a", "b"], words)


def test_appends_shuffle_stored_keys_in_proportion_to_the_batch(spark, tmp_path):
    def readings(first, last):
        return spark.range(first, last).selectExpr(
            "timestamp'2026-08-01 00:00:00' + make_dt_interval(cast(id % 20 as int)) as time",
            "lpad(cast(id as string), 5, '0') as nom_poi", "id as reading_id")
    readings(0, 60_000).write.parquet(f"{tmp_path}/stored")
    readings(59_900, 60_050).write.parquet(f"{tmp_path}/batch")
    stored, batch = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("stored", "batch"))
    order = dedup.ascending(["reading_id"])
    assert [r.reading_id for r in append.new_readings(batch, stored, order).orderBy("reading_id").collect()] == list(range(60_000, 60_050))
    assert tuple(append.ingest_counts(batch, stored).first()) == (150, 50, 100)
    assert append.new_by_hash(batch, stored).count() == 50
    assert append.new_by_key(batch, stored, ["nom_poi"]).count() == 50
    # what goes on to the shuffle
    keys, names = append._key_texts(append._keyed(batch), append.KEY)
    known = append._key_texts(append.stored_keys(stored), append.KEY)[0]
    assert 100 <= may_hold(known, keys, names).count() <= 110
    text = plan(append.new_readings(batch, stored, order))
    assert "LeftSemi" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_batches_and_stored_tables_without_rows(spark):
    some = spark.createDataFrame([("1", 1), (None, 2), (None, 3)], "k string, v int")
    assert rows(append.new_by_key(some, some.where("false"), ["k"])) == [("1", 1), (None, 2)]
    assert append.new_by_key(some.where("false"), some, ["k"]).count() == 0
    assert append.new_by_key(some, some.where("k is null"), ["k"]).select(F.first("v")).first()[0] == 1
