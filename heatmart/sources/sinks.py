"""Writing tables: conforming appends, full rebuilds, month partitions, touched months.

Plain Parquet has no concurrent writers' protocol: one writer per table.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F, types as T

from heatmart.operators.scale import cut_lineage, exists, released


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the stored schema; missing columns become NULL, unknown ones drop."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def append(df: DataFrame, path: str, schema: T.StructType | None = None,
           fmt: str = "parquet") -> bool:
    """Append rows; an empty batch writes nothing and answers False."""
    rows = conform(df, schema) if schema is not None else df
    if rows.isEmpty():
        return False
    rows.write.mode("append").format(fmt).save(path)
    return True


def rebuild(df: DataFrame, path: str) -> None:
    """Full rebuild of a table. Never pass a plan that reads ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def with_month(df: DataFrame, day: str = "date") -> DataFrame:
    return df.withColumn("date_month", F.trunc(day, "MM"))


def _by_month(df: DataFrame, day: str) -> DataFrame:
    # rebalance gathers a month into few files and still splits a month too big for one task
    return with_month(df, day).hint("rebalance", F.col("date_month"))


def rebuild_by_month(df: DataFrame, path: str, day: str = "date") -> None:
    """Full rebuild of a table partitioned by month."""
    (_by_month(df, day).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("date_month").parquet(path))


def rebuild_from(df: DataFrame, path: str, first: date, day: str = "date") -> None:
    """Replace the months of df from that of ``first`` on; df holds all their rows.

    Other months keep their files. df must not read ``path``.
    """
    _replace_months(df.where(F.col(day) >= F.lit(first.replace(day=1))), path, day)


@released()
def upsert_months(fresh: DataFrame, path: str, keys: list[str], day: str = "date") -> None:
    """Merge rows into a table partitioned by month; only the touched months are read and written.

    Stored rows stay unless fresh has their key. NULL keys match nothing.
    """
    spark = fresh.sparkSession
    fresh = with_month(fresh, day)
    if not exists(spark, path):
        return rebuild_by_month(fresh.drop("date_month"), path, day)
    # as many rows as the delta has calendar months
    months = [r[0] for r in fresh.select("date_month").distinct().collect()]
    stored = spark.read.parquet(path)
    stored = stored.where(F.col("date_month").isin(months) if months else F.lit(False))
    kept = stored.join(fresh.select(*keys).distinct(), keys, "left_anti")
    # the plan reads the table it writes to, so the rows are written out first
    _replace_months(cut_lineage(kept.unionByName(fresh).drop("date_month")), path, day)


def _replace_months(df: DataFrame, path: str, day: str) -> None:
    """Replace the months present in df; df must not read ``path``."""
    (_by_month(df, day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date_month").parquet(path))


def delta(fresh: DataFrame, stored: DataFrame, keys: list[str], day: str = "date") -> DataFrame:
    """Rows whose key is not stored yet, with the month they touch."""
    known = stored.select(*keys).distinct()
    return with_month(fresh.join(known, keys, "left_anti"), day)
