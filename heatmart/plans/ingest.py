"""Ingestion runs: landed files to raw tables, idempotent, gated, one feed at a time.

A run may be repeated at any time; what is stored is skipped. Each raw table
has a single writer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from heatmart import schemas
from heatmart.operators import append
from heatmart.operators.dedup import ascending
from heatmart.operators.scale import cut_lineage, exists, released
from heatmart.sources import landing, sinks


@dataclass
class Outcome:
    """What a run did."""

    received: int = 0
    inserted: int = 0
    verdict: str = "accepted"
    unreadable: int = 0
    unmatched: int = 0

    @property
    def skipped(self) -> int:
        return self.received - self.inserted


def stored_table(spark: SparkSession, path: str,
                 schema: T.StructType | None = None) -> DataFrame | None:
    """A stored Parquet table, or None before its first load.

    A folder without readable files is an error, not a first load.
    """
    if not exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def _stored_weather(spark: SparkSession, path: str) -> DataFrame:
    stored = stored_table(spark, path, schemas.RAW_WEATHER)
    return spark.createDataFrame([], schemas.RAW_WEATHER) if stored is None else stored


def _append(fresh: DataFrame, path: str) -> int:
    # the plan reads the table it appends to, so the rows are written out first
    fresh = cut_lineage(fresh)
    inserted = fresh.count()
    if inserted:
        sinks.append(fresh, path)
    return inserted


def _lost(landed: DataFrame, parsed: DataFrame, locations: DataFrame) -> tuple[int, int]:
    """Numbers of unreadable bodies and of payload locations that are not listed."""
    return landing.unreadable(landed).count(), landing.unmatched(parsed, locations).count()


@released()
def daily_weather(landed: DataFrame, locations: DataFrame, path: str, as_of: date,
                  lookback: int = 60, limit: float = 50.0, tolerated: int = 0) -> Outcome:
    """Daily run: keep unknown (day, code), refuse a batch lacking maxima, append.

    A landing with more than ``tolerated`` unreadable bodies or unlisted
    locations is refused as a whole.
    """
    spark = landed.sparkSession
    landed = cut_lineage(landing.opened(landed).select("batch_id", "doc"))
    parsed = landing.parse_payloads(landed)
    unreadable, unmatched = _lost(landed, parsed, locations)
    if unreadable + unmatched > tolerated:
        return Outcome(verdict="refused", unreadable=unreadable, unmatched=unmatched)
    batch = landing.daily_readings(parsed, locations)
    batch = cut_lineage(sinks.conform(batch, schemas.RAW_WEATHER))
    order = ascending(schemas.RAW_WEATHER.names)
    fresh = cut_lineage(append.new_readings(batch, _stored_weather(spark, path), order,
                                            as_of, lookback))
    gate = append.batch_gate(fresh, limit=limit).first()
    outcome = Outcome(batch.count(), gate["total"], gate["verdict"], unreadable, unmatched)
    if gate["verdict"] == "refused":
        outcome.inserted = 0
    elif gate["total"]:
        sinks.append(fresh, path)
    return outcome


@released()
def history_weather(landed: DataFrame, locations: DataFrame, path: str, first: date,
                    last: date, tolerated: int = 0) -> Outcome:
    """History run: complete days only, unknown (day, name), hash and load time stamped.

    Refused as daily_weather() is.
    """
    spark = landed.sparkSession
    landed = cut_lineage(landing.opened(landed).select("batch_id", "doc"))
    parsed = landing.parse_payloads(landed)
    unreadable, unmatched = _lost(landed, parsed, locations)
    if unreadable + unmatched > tolerated:
        return Outcome(verdict="refused", unreadable=unreadable, unmatched=unmatched)
    batch = cut_lineage(landing.complete_readings(parsed, locations))
    fresh = append.new_by_hash(batch, _stored_weather(spark, path), first, last)
    fresh = sinks.conform(fresh.withColumn("insere_a", F.current_timestamp()),
                          schemas.RAW_WEATHER)
    return Outcome(batch.count(), _append(fresh, path), unreadable=unreadable, unmatched=unmatched)


@dataclass
class Feed:
    """A health feed: its records, its table, how rows are renamed and told apart."""

    records: DataFrame
    path: str
    mapper: Callable[[DataFrame], DataFrame] | None = None
    key: list[str] | None = None


@released()
def health_feed(feed: Feed) -> Outcome:
    spark = feed.records.sparkSession
    fresh = landing.load_records(feed.records, stored_table(spark, feed.path),
                                 feed.mapper, feed.key)
    return Outcome(feed.records.count(), _append(fresh, feed.path))


@dataclass
class Report:
    done: dict[str, Outcome] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


def health_feeds(feeds: dict[str, Feed]) -> Report:
    """Load every feed; one that fails does not stop the others."""
    report = Report()
    for name, feed in feeds.items():
        try:
            report.done[name] = health_feed(feed)
        except Exception as error:  # whatever it is, the other feeds go on
            report.failed[name] = str(error)
    return report
