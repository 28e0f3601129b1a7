"""Structured Streaming over landed readings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from heatmart.functions.text import stored_code
from heatmart.operators import states
from heatmart.operators.dedup import best_order
from heatmart.operators.scale import cut_lineage, released
from heatmart.sources import changes, versions
from heatmart.sources.changes import in_months  # noqa: F401
from heatmart.sources.sinks import with_month

KEYS = ["date", "code_insee"]


def first_readings(stream: DataFrame, keys: list[str], time: str = "time",
                   horizon: str = "15 days") -> DataFrame:
    """First reading seen per key. State is kept no longer than the late horizon."""
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark(keys)


def best_readings(stream: DataFrame, ties: list[str], maximum: str = "temperature_max",
                  felt: str = "temperature_ressentie_max", time: str = "time", horizon: str = "15 days") -> DataFrame:
    """The best reading so far of each (date, code_insee), sent again whenever it changes.

    The same preference as best_reading(), as an aggregate: the least of the
    order's columns. For update mode. The day's window lets state go once the
    watermark has passed it; readings later than the horizon are for
    build.merge().
    """
    order = F.struct(F.col(maximum).isNull(), F.col(felt).isNull(),
                     *[F.struct(F.col(c).isNull(), F.col(c)) for c in ties])
    rows = stream.where(F.col("code_insee").isNotNull()).withWatermark(time, horizon)
    best = rows.groupBy(F.window(time, "1 day"), *KEYS).agg(
        F.min_by(F.struct(*[c for c in stream.columns if c not in KEYS]), order).alias("best"))
    return best.select(*KEYS, "best.*")


def add_new(rows: DataFrame, fact: str) -> None:
    """Append the coming rows whose key is not stored yet; only their months are read."""
    fresh = changes.coming(rows)
    stored = changes.stored_months(rows.sparkSession, fact, changes.touched_months(rows))
    if stored is not None:
        fresh = fresh.join(stored.select(*KEYS), KEYS, "left_anti")
    # the plan reads the table it appends to, so it is written out first
    cut_lineage(fresh).write.mode("append").partitionBy("date_month").parquet(fact)


def count_changes(rows: DataFrame, tag: str, fact: str, report: str) -> None:
    """Merge changes that the fact has already into the monthly report; those of a tag count once.

    Without a report yet, the fact is counted whole.
    """
    spark = rows.sparkSession
    last = versions.current(spark, report)
    panel = spark.read.parquet(fact)
    if last is None:
        total = states.states(_measured(panel))
    elif last[1] == tag:
        return
    else:
        total = states.merged(spark.read.parquet(last[0]), cut_lineage(states.deltas(_measured(rows))),
                              lambda groups: states.of_groups(_measured(panel), groups))
    versions.publish(total.coalesce(1), report, tag)


def _measured(df: DataFrame) -> DataFrame:
    """The columns a monthly report counts."""
    name = next(c for c in ("temperature_maximale", "temperature_max") if c in df.columns)
    return df.select("date", F.col(name).alias("temperature_maximale"), *[c for c in df.columns if c == changes.SIGN])


Find = Callable[[DataFrame, DataFrame | None], DataFrame]


def _kept(fact: str, report: str, find: Find, put: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
    """Micro-batches: changes against the touched months, written down, put into the fact, counted in the report."""
    @released()
    def step(batch: DataFrame, _: int) -> None:
        spark: SparkSession = batch.sparkSession

        def found() -> DataFrame:
            rows = cut_lineage(with_month(batch.where("date is not null")))
            return find(rows, changes.stored_months(spark, fact, changes.touched_months(rows)))
        changes.carry_out(spark, f"{fact.rstrip('/')}-changes", found, [
            lambda rows, tag: put(rows, fact), lambda rows, tag: count_changes(rows, tag, fact, report)])
    return step


def _dated(stream: DataFrame) -> DataFrame:
    return (stream.where("time is not null").withColumn("date", F.to_date("time"))
            .withColumn("code_insee", stored_code(F.col("nom_poi"))))


def follow(stream: DataFrame, fact: str, report: str, checkpoint: str,
           order: list[Column]) -> StreamingQuery:
    """Append landed readings, the first of each key, and keep the monthly heat-day report current.

    One writer. A batch is compared with the months it touches; the report
    takes the rows added, months are not counted again. What depends on the
    batch and the stored table only ends in the same state when it runs again,
    and changes that were written down but not all applied are finished first.
    """
    step = _kept(fact, report, lambda rows, stored: changes.new_changes(rows, stored, KEYS, order), add_new)
    return (_dated(stream).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def follow_best(stream: DataFrame, fact: str, report: str, checkpoint: str, ties: list[str],
                maximum: str = "temperature_max", felt: str = "temperature_ressentie_max",
                horizon: str = "15 days", dated: bool = False) -> StreamingQuery:
    """Keep the best reading of each (date, code_insee) in the fact, and the monthly heat-day report with it.

    Whatever the order of arrival within the horizon, the fact is that of
    best_reading() over all readings, stored ones included: each batch brings
    the best so far of its keys, which replaces the stored row if it is
    better. The report loses what goes and gains what comes. ``dated`` streams
    have date and code_insee already.
    """
    best = best_readings(stream if dated else _dated(stream), ties, maximum, felt, horizon=horizon)
    order = best_order(ties, maximum, felt)
    step = _kept(fact, report, lambda rows, stored: changes.best_changes(rows, stored, KEYS, order),
                 lambda rows, path: changes.put(rows, path, KEYS))
    return (best.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
