"""Keeping plans sound at cluster scale: checked broadcasts, cut lineage, spread keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

# Broadcast only below this measured size; beyond it the join shuffles and
# adaptive execution splits hot keys.
BROADCAST_BYTES = 64 * 1024 * 1024
# Intermediate tables written in the innermost released() block of this thread.
_WRITTEN: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("written", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables and stream state.

    A cluster names it in spark.checkpoint.dir. Only a local master may fall
    back to a temporary folder, kept for the rest of the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="heatmart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at path, as the file system says."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def released() -> Iterator[None]:
    """Delete the intermediate tables of a block, or of a decorated function, at its end.

    Nothing that outlives the block may read from them: write results first.
    """
    written: list[tuple[SparkSession, str]] = []
    outer = _WRITTEN.set(written)
    try:
        yield
    finally:
        _WRITTEN.reset(outer)
        for spark, path in written:
            remove(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df once as a table in the shared folder and go on from the files.

    A lost executor then costs a re-read, never a recomputation, and Catalyst
    prunes columns and knows the size of what follows.
    """
    return stored_and_measured(df)[0]


def stored_and_measured(df: DataFrame, **figures: Column) -> tuple[DataFrame, dict]:
    """cut_lineage() plus aggregates gathered while the table is written.

    Besides the given figures there is always ``bytes``, the size in memory. A
    task that runs twice can only raise it.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    if (written := _WRITTEN.get()) is not None:
        written.append((df.sparkSession, path))
    seen = Observation()
    watched = df.observe(seen, F.sum(row_bytes(df)).alias("bytes"),
                         *[c.alias(n) for n, c in figures.items()])
    watched.write.parquet(path)
    found = {**seen.get, "bytes": seen.get["bytes"] or 0}
    return df.sparkSession.read.schema(df.schema).parquet(path), found


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's in-memory size."""
    size = F.lit(16 + 8 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    return size


def spread_nulls(key: Column, *by: Column) -> Column:
    """Replace NULL join keys by distinct texts that match nothing.

    In an outer join all NULL keys would land in one partition. The leading
    NUL character keeps the replacement apart from every real key.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.xxhash64(*by).cast("string")))
