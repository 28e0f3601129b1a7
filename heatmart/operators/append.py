"""Idempotent appends: what of a new batch is not stored yet.

Stored keys that the batch cannot hold go before the shuffle (operators.membership), so
what is shuffled grows with the batch, not with the stored window. The batch is read
twice: give it stored, or cheap to read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from heatmart.functions.dates import since_days
from heatmart.functions.text import midnight_text, reading_hash, stored_code
from heatmart.operators.dedup import ascending, first_per_key
from heatmart.operators.membership import may_hold


def _key_texts(df: DataFrame, key: list[str]) -> tuple[DataFrame, list[str]]:
    """Add text forms of the key columns in which a missing part equals a missing part.

    Plain equality on them lets a ranking and the anti-join after it share one
    partitioning; a NULL-safe comparison would shuffle the batch again.
    """
    names = [f"_k{i}" for i in range(len(key))]
    texts = {n: F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for n, c in zip(names, key)}
    return df.withColumns(texts), names


def _unknown(df: DataFrame, known: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """First row of each key that ``known`` lacks."""
    keyed, names = _key_texts(df, key)
    stored = may_hold(_key_texts(known, key)[0].select(*names), keyed, names).distinct()
    return first_per_key(keyed, names, order).join(stored, names, "left_anti").drop(*names)


def stored_keys(stored: DataFrame, as_of: date | None = None, lookback: int = 60) -> DataFrame:
    """(date, code) already stored, looking back a bounded number of days."""
    days = stored.withColumn("date", F.to_date("time"))
    if as_of is not None:
        days = days.where(since_days(F.col("date"), as_of, lookback))
    return days.select("date", stored_code(F.col("nom_poi")).alias("code_insee"))


KEY = ["date", "code_insee"]


def _keyed(batch: DataFrame) -> DataFrame:
    return (batch.withColumn("date", F.to_date("time"))
            .withColumn("code_insee", F.col("nom_poi").cast("string")))


def new_readings(batch: DataFrame, stored: DataFrame, order: list[Column],
                 as_of: date | None = None, lookback: int = 60) -> DataFrame:
    """Readings to insert: key not stored, and of repeats in the batch the first one.

    The batch is shuffled once, after a map-side reduction to one row per key.
    """
    known = stored_keys(stored, as_of, lookback)
    return _unknown(_keyed(batch), known, KEY, order).drop(*KEY)


def ingest_counts(batch: DataFrame, stored: DataFrame, as_of: date | None = None,
                  lookback: int = 60) -> DataFrame:
    """Received, new and skipped readings of a run, from per-key counts."""
    keyed, names = _key_texts(_keyed(batch), KEY)
    copies = keyed.groupBy(*names).agg(F.count("*").alias("copies"))
    known = _key_texts(stored_keys(stored, as_of, lookback), KEY)[0].select(*names)
    known = may_hold(known, keyed, names).distinct().withColumn("_known", F.lit(True))
    return copies.join(known, names, "left").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("received"),
        F.count_if(F.col("_known").isNull()).alias("inserted"),
    ).withColumn("skipped", F.col("received") - F.col("inserted"))


def new_by_hash(batch: DataFrame, stored: DataFrame, first: date | None = None,
                last: date | None = None) -> DataFrame:
    """Readings whose (day, name) is not stored in the window; repeats in the batch stay.

    Equal hashes mean equal (day, name), so the join compares those and the
    hash is only computed for the rows that go in.
    """
    day = F.to_date("time")
    if first is not None:
        stored = stored.where(day >= F.lit(first))
    if last is not None:
        stored = stored.where(day <= F.lit(last))
    known = stored.select(midnight_text(F.col("time")).alias("_time"),
                          F.col("nom_poi").alias("_name"))
    keys = batch.select(midnight_text(F.col("time")).alias("_time"), F.col("nom_poi").alias("_name"))
    known = may_hold(known, keys, ["_time", "_name"]).distinct()
    same = (midnight_text(F.col("time")) == F.col("_time")) & (F.col("nom_poi") == F.col("_name"))
    return (batch.join(known, same, "left_anti")
            .withColumn("row_hash", reading_hash(F.col("time"), F.col("nom_poi"))))


def new_by_key(records: DataFrame, existing: DataFrame | None, key: list[str]) -> DataFrame:
    """Records with a key not stored yet, one per key."""
    order = ascending(sorted(c for c in records.columns if c not in key))
    if existing is None:
        return first_per_key(records, key, order)
    return _unknown(records, existing, key, order)


def expected_keys(locations: DataFrame, first: date, last: date) -> DataFrame:
    """Every (day, code) of a collection window."""
    days = F.explode(F.sequence(F.lit(first), F.lit(last)))
    return locations.select(days.alias("date"), F.col("code_insee"))


def missing_keys(locations: DataFrame, stored: DataFrame, first: date, last: date) -> DataFrame:
    """(day, code) of the window that are not stored."""
    known = (stored.where(F.to_date("time").between(F.lit(first), F.lit(last)))
             .select(F.to_date("time").alias("date"),
                     stored_code(F.col("nom_poi")).alias("code_insee")))
    return expected_keys(locations, first, last).join(known.distinct(), ["date", "code_insee"], "left_anti")


def batch_gate(batch: DataFrame, column: str = "temperature_2m_max",
               limit: float = 50.0) -> DataFrame:
    """Verdict on a batch: refused when more than ``limit`` % lack the column."""
    counted = batch.agg(F.count("*").alias("total"),
                        F.count_if(F.col(column).isNull()).alias("missing"))
    share = F.try_divide(F.lit(100.0) * F.col("missing"), F.col("total"))
    return counted.withColumn("missing_pct", F.coalesce(share, F.lit(0.0))).withColumn(
        "verdict", F.when(F.col("missing_pct") > limit, "refused")
        .when(F.col("missing") > 0, "warning").otherwise("accepted"))
