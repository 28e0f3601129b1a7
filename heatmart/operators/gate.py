"""Declared checks while a table is written, and the rows that fail them put aside.

What a single row can tell (missing values, ranges, markers) and whether a column
holds enough different values is observed on the write itself, so a clean table is
not read again for them. Uniqueness and references read their key columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from heatmart.operators.quality import SENTINELS, Checks, out_of_range, run_checks, too_few
from heatmart.operators.scale import exists, remove
from heatmart.sources.sinks import rebuild


def row_rules(checks: Checks) -> dict[tuple[str, str], Column]:
    """(column, check) of every promise about single rows, with what breaks it."""
    rules: dict[tuple[str, str], Column] = {}
    for c in checks.not_null:
        rules[c, "not_null"] = F.col(c).isNull()
    for c, (low, high) in checks.ranges.items():
        rules[c, "range"] = out_of_range(c, low, high)
    for c in checks.no_sentinel:
        rules[c, "sentinel"] = F.col(c).isin(*SENTINELS)
    return rules


def failing_rows(df: DataFrame, checks: Checks) -> DataFrame:
    """Rows that break a promise about single rows, with all they break in ``reasons``."""
    broken = [F.when(rule, F.lit(f"{c} {kind}")) for (c, kind), rule in row_rules(checks).items()]
    reasons = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def _at_least(column: str) -> Column:
    """Aggregate of 4 KB: a number of different values that the column surely holds, up to 32,768."""
    place = F.bitmap_bit_position(F.xxhash64(column).bitwiseAND(F.lit(32767).cast("long")) + 1)
    return F.bitmap_count(F.bitmap_construct_agg(F.when(F.col(column).isNotNull(), place)))


def write_checked(df: DataFrame, model: str, checks: Checks, path: str, quarantine: str,
                  write: Callable[[DataFrame, str], None] = rebuild, models: dict[str, DataFrame] | None = None) -> DataFrame:
    """Write a model and answer run_checks() for it: (model, column, check, violations, status).

    The table keeps all rows. Copies of those that break a promise about single
    rows go to ``quarantine`` with their reasons; without any there is no such
    table. A task that runs twice may be observed twice, which cannot turn
    none into some or the other way round; how many rows fail is counted in
    the quarantine. Likewise few values observed lead to an exact count.
    """
    spark, rules = df.sparkSession, row_rules(checks)
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(rule).alias(f"{c}|{kind}") for (c, kind), rule in rules.items()],
                     *[_at_least(c).alias(f"{c}|coverage") for c in checks.more_than]), path)
    stored, found = spark.read.schema(df.schema).parquet(path), seen.get
    violations = dict.fromkeys(rules, 0)
    if any(found.get(f"{c}|{kind}") for c, kind in rules):
        rebuild(failing_rows(stored, checks), quarantine)
        reasons = spark.read.parquet(quarantine).select(F.explode("reasons").alias("r")).groupBy("r").count()
        counted = {r["r"]: r["count"] for r in reasons.collect()}  # as many as there are checks
        violations = {(c, kind): counted.get(f"{c} {kind}", 0) for c, kind in rules}
    elif exists(spark, quarantine):
        remove(spark, quarantine)
    for c, least in checks.more_than.items():
        enough = (found.get(f"{c}|coverage") or 0) > least
        violations[c, "coverage"] = 0 if enough else int(stored.agg(too_few(c, least)).first()[0])
    shape = "model string, column string, check string, violations long, status string"
    done = spark.createDataFrame(
        [(model, c, kind, n, "fail" if n else "pass") for (c, kind), n in violations.items()], shape)
    if checks.unique or checks.references:
        done = done.unionByName(run_checks(model, stored, Checks(unique=checks.unique, references=checks.references), models))
    return done
