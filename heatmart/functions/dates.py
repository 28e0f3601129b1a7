"""Calendar helpers."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

# Month labels of the calendar dimension, January first.
MONTH_LABELS = ["Janv.", "Févr.", "Mars", "Avr.", "Mai", "Juin",
                "Juil.", "Août", "Sept.", "Oct.", "Nov.", "Déc."]


def month_label(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_LABELS]), F.month(day))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def collection_window(as_of: date, lag: int = 5, span: int = 10) -> tuple[date, date]:
    """First and last day (both included) a run collects again."""
    last = as_of - timedelta(days=lag)
    return last - timedelta(days=span), last


def since_days(day: Column, as_of: date, days: int) -> Column:
    return day >= F.date_sub(F.lit(as_of), days)


def between_days(df: DataFrame, first: date | None = None, last: date | None = None,
                 day: str = "date", month: str = "date_month") -> DataFrame:
    """Keep a span of days; on a month-partitioned table also prune partitions.

    Spark cannot derive the month predicate from the day predicate, so both
    are stated.
    """
    pruned = month in df.columns
    if first is not None:
        df = df.where(F.col(day) >= F.lit(first))
        if pruned:
            df = df.where(F.col(month) >= F.lit(first.replace(day=1)))
    if last is not None:
        df = df.where(F.col(day) <= F.lit(last))
        if pruned:
            df = df.where(F.col(month) <= F.lit(last.replace(day=1)))
    return df
