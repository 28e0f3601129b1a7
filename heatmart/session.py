"""Session defaults shared by the bench, the tests and stand-alone jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot places and hot days are split at run time, also where the split
    # costs one more exchange: a third of all rows in one task costs far more.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def sized_for(input_bytes: int, part: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings for a job that reads about this much.

    Adaptive execution merges small shuffle partitions but cannot cut one that
    is evenly too big, so the first number must suit the data.
    """
    parts = max(200, -(-input_bytes // part))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(part),
            "spark.sql.files.maxPartitionBytes": str(part)}


def measured(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files under paths; those that are not there yet count as empty."""
    jvm, conf, total = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(conf)
        if files.exists(at):
            total += files.getContentSummary(at).getLength()
    return total


def session(app: str = "heatmart", master: str | None = None,
            extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master`` stays unset on a cluster, where spark-submit names it; ``extra``
    takes sized_for() there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
