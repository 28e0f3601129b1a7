"""Run metrics: the emissions log and the per-step metrics file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heatmart import schemas


def read_emissions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EMISSIONS_LOG).option("header", True).csv(path)


def parse_steps(texts: DataFrame, body: str = "value") -> DataFrame:
    """Step metrics from texts holding one JSON object keyed by step."""
    steps = F.from_json(F.col(body), schemas.STEP_METRICS)
    return (texts.select(F.explode(steps).alias("name", "metrics"))
            .select(F.coalesce("metrics.step", "name").alias("step"),
                    "metrics.emissions_kg_co2", "metrics.duration_seconds", "metrics.status"))


def read_steps(spark: SparkSession, path: str) -> DataFrame:
    return parse_steps(spark.read.text(path, wholetext=True))
