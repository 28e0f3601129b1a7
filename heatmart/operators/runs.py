"""Reports about tables and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def inventory(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(dataset, table) -> rows, columns and stored mebibytes of file-backed tables.

    All tables are counted in one pass over their files' metadata; a table
    without rows is listed with zeros.
    """
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame([(*key, len(df.columns)) for key, df in tables.items()],
                                   "dataset string, table string, colonnes int")
    parts = [df.select(F.lit(dataset).alias("dataset"), F.lit(name).alias("table"),
                       "_metadata.file_path", "_metadata.file_size")
             for (dataset, name), df in tables.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    files = rows.groupBy("dataset", "table", "file_path").agg(
        F.count("*").alias("n"), F.max("file_size").alias("bytes"))
    totals = files.groupBy("dataset", "table").agg(F.sum("n").alias("n"),
                                                   F.sum("bytes").alias("bytes"))
    return listed.join(totals, ["dataset", "table"], "left").select(
        "dataset", "table", F.coalesce("n", F.lit(0)).alias("lignes"), "colonnes",
        F.round(F.coalesce("bytes", F.lit(0)) / 1024 ** 2, 1).alias("taille_mo"),
    ).orderBy("dataset", F.desc("lignes"), "table")


def step_totals(steps: DataFrame) -> DataFrame:
    """Emissions and duration per step, with a TOTAL row."""
    return (steps.rollup("step").agg(
        F.coalesce(F.sum("emissions_kg_co2"), F.lit(0.0)).alias("co2_kg"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("time_s"),
        F.grouping("step").alias("_total"))
        .select(F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("step")).alias("step"),
                "co2_kg", "time_s"))
