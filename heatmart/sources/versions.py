"""Tables published whole: a new folder per version, complete or not there at all.

A version counts from the moment its writer's success marker exists, so readers
see the one before until then, and a job that fails on the way leaves it as it
is. One writer per table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from heatmart.operators.scale import remove

_NAME = re.compile(r"v(\d{8})-(.*)")


def _listed(spark: SparkSession, path: str) -> list[tuple[int, str, str, bool]]:
    """(number, tag, folder, complete) of every version, oldest first."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    found = []
    for entry in files.listStatus(at):
        if match := _NAME.fullmatch(entry.getPath().getName()):
            folder = f"{path.rstrip('/')}/{entry.getPath().getName()}"
            done = files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS"))
            found.append((int(match[1]), match[2], folder, done))
    return sorted(found)


def current(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(folder, tag) of the latest complete version."""
    complete = [(folder, tag) for _, tag, folder, done in _listed(spark, path) if done]
    return complete[-1] if complete else None


def read(spark: SparkSession, path: str) -> DataFrame:
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no complete version under {path}")
    return spark.read.parquet(found[0])


def publish(df: DataFrame, path: str, tag: str = "", keep: int = 2) -> None:
    """Write df as the next version; ``keep`` complete versions stay, for readers that began on an older one.

    df may read the current version. What failed writers left goes as well.
    """
    spark = df.sparkSession
    before = _listed(spark, path)
    number = before[-1][0] + 1 if before else 0
    df.write.parquet(f"{path.rstrip('/')}/v{number:08d}-{tag}")
    complete = [folder for *_, folder, done in before if done]
    kept = set(complete[len(complete) + 1 - keep:]) if keep > 1 else set()
    for *_, folder, _ in before:
        if folder not in kept:
            remove(spark, folder)
