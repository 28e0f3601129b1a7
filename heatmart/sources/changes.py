"""Changes of a table partitioned by month: rows that come (sign 1) and rows that go (sign -1).

Changes are found against the stored months they touch, written down, and then
applied step by step. Every step may run twice, so a job that breaks off
midway is finished by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heatmart.operators.dedup import first_per_key
from heatmart.operators.scale import cut_lineage, exists, remove
from heatmart.sources import versions
from heatmart.sources.sinks import upsert_months, with_month

SIGN = "sign"


def touched_months(df: DataFrame) -> list:
    """First days of the months in df, as many as the calendar has for it."""
    return [r[0] for r in df.select("date_month").where("date_month is not null").distinct().collect()]


def in_months(table: DataFrame, months: list) -> DataFrame:
    """A table's partitions of these months; their literals reach the file listing."""
    return table.where(F.col("date_month").isin(months) if months else F.lit(False))


def stored_months(spark: SparkSession, path: str, months: list) -> DataFrame | None:
    """Rows of some months of the table at path, if there is one."""
    return in_months(spark.read.parquet(path), months) if exists(spark, path) else None


def best_changes(fresh: DataFrame, stored: DataFrame | None, keys: list[str], order: list[Column]) -> DataFrame:
    """What changes when each key keeps the first row of fresh and stored ones; a stored row wins ties.

    Only stored rows of a fresh key are ranked. A choice by a total order does
    not depend on when a row arrives: the first of firsts is the first of all.
    """
    best = first_per_key(fresh, keys, order)
    if stored is None:
        return best.withColumn(SIGN, F.lit(1))
    met = stored.join(best.select(*keys), keys, "left_semi")
    both = best.withColumn("_old", F.lit(0)).unionByName(met.withColumn("_old", F.lit(1)), allowMissingColumns=True)
    ranked = first_per_key(both, keys, [*order, F.desc("_old")])
    # worked out once: both parts of the answer read it
    come = cut_lineage(ranked.where("_old = 0").drop("_old"))
    gone = stored.join(come.select(*keys), keys, "left_semi")
    return come.withColumn(SIGN, F.lit(1)).unionByName(gone.withColumn(SIGN, F.lit(-1)), allowMissingColumns=True)


def new_changes(fresh: DataFrame, stored: DataFrame | None, keys: list[str], order: list[Column]) -> DataFrame:
    """The first fresh row of each key that is not stored yet; nothing goes."""
    best = first_per_key(fresh, keys, order)
    if stored is not None:
        best = best.join(stored.select(*keys), keys, "left_anti")
    return best.withColumn(SIGN, F.lit(1))


def coming(changes: DataFrame) -> DataFrame:
    return changes.where(F.col(SIGN) == 1).drop(SIGN)


def put(changes: DataFrame, path: str, keys: list[str]) -> None:
    """Write the coming rows over stored ones of their keys; other months keep their files."""
    upsert_months(coming(changes).drop("date_month"), path, keys)


Step = Callable[[DataFrame, str], None]


def carry_out(spark: SparkSession, log: str, find: Callable[[], DataFrame], steps: list[Step]) -> int:
    """Finish what an earlier run left under ``log``, then find, write down and apply changes; how many.

    A step gets the changes and their tag, and must end in the same state when
    run again. Changes are found after unfinished ones are in place.
    """
    def finish() -> int:
        folder, tag = versions.current(spark, log)
        changes = spark.read.parquet(folder)
        count = changes.count()
        for step in steps if count else []:
            step(changes, tag)
        remove(spark, log)
        return count

    if versions.current(spark, log):
        finish()
    versions.publish(find(), log, uuid.uuid4().hex)
    return finish()


def dated(df: DataFrame) -> DataFrame:
    """With the month each row lies in."""
    return with_month(df)
