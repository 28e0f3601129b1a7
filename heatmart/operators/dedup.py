"""One row per key, chosen by a total order so results do not depend on partitioning.

A row_number() filter of 1 lets Catalyst put a group limit before the shuffle:
every map task sends at most one row per key, so a hot key stays harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from heatmart.functions.text import record_hash


def ascending(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_last() for c in columns]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key. NULL keys form one group, as in SQL."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def one_per_commune(communes: DataFrame, key: str = "code_insee") -> DataFrame:
    """One row per official code; every other column breaks ties, in name order."""
    rest = sorted(c for c in communes.columns if c != key)
    return first_per_key(communes, [key], ascending(rest))


def best_order(ties: list[str], maximum: str = "temperature_max",
               felt: str = "temperature_ressentie_max") -> list[Column]:
    """Better readings first: a present maximum, then a present felt maximum."""
    return [F.col(maximum).isNull(), F.col(felt).isNull()] + ascending(ties)


def best_reading(readings: DataFrame, keys: list[str], ties: list[str],
                 maximum: str = "temperature_max",
                 felt: str = "temperature_ressentie_max") -> DataFrame:
    """One reading per key, the best one."""
    return first_per_key(readings, keys, best_order(ties, maximum, felt))


def latest_per_key(df: DataFrame, keys: list[str], loaded: str, ties: list[str]) -> DataFrame:
    """One row per key, the last loaded one."""
    return first_per_key(df, keys, [F.col(loaded).desc_nulls_last()] + ascending(ties))


def distinct_records(records: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Whole-record deduplication by hash, inside the batch and against a stored table."""
    columns = records.columns
    hashed = records.distinct().withColumn("record_hash", record_hash(columns))
    if existing is None:
        return hashed
    known = existing.select("record_hash").where("record_hash is not null").distinct()
    return hashed.join(known, "record_hash", "left_anti").select(*columns, "record_hash")
