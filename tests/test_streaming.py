"""Streams over landed files against their batch counterparts."""

from datetime import datetime

from pyspark.sql import functions as F

from heatmart.operators.dedup import ascending
from heatmart.sources import versions
from heatmart.streaming import incremental
from support import rows

SCHEMA = "time timestamp, nom_poi string, temperature_maximale double, n int"


def land(spark, folder, items):
    spark.createDataFrame(items, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_first_readings(spark, tmp_path):
    land(spark, f"{tmp_path}/in", [(datetime(2026, 8, d), "1", 1.0, d) for d in (1, 2, 2, 3, 3)])
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in").withColumn(
        "date", F.to_date("time"))
    first = incremental.first_readings(stream, ["date", "nom_poi"])
    (first.writeStream.format("parquet").option("path", f"{tmp_path}/out")
     .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True)
     .start().awaitTermination())
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_follow_appends_once_and_survives_a_replay(spark, tmp_path):
    def run(state):
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        incremental.follow(stream, f"{tmp_path}/fact", f"{tmp_path}/report", f"{tmp_path}/{state}",
                           ascending(["n"])).awaitTermination()
        return (spark.read.parquet(f"{tmp_path}/fact").count(),
                rows(versions.read(spark, f"{tmp_path}/report").select(
                    F.month("date_month"), "jours_sup_30", "jours_sup_35")))

    land(spark, f"{tmp_path}/in", [(datetime(2026, 7, 1), "1034", 31.0, 1),
                                   (datetime(2026, 7, 1), "01034", 36.0, 2),
                                   (datetime(2026, 8, 1), "1034", 36.0, 3)])
    assert run("s1") == (2, [(7, 1, 0), (8, 1, 1)])
    land(spark, f"{tmp_path}/in", [(datetime(2026, 8, 1), "01034", 41.0, 4),
                                   (datetime(2026, 8, 2), "01034", 41.0, 5), (None, "1", 1.0, 6)])
    expected = (3, [(7, 1, 0), (8, 2, 2)])
    assert run("s1") == expected
    # a lost checkpoint replays every file: nothing is added twice
    assert run("s2") == expected
