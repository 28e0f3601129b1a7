"""Turning wide one-row results into one row per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def to_rows(df: DataFrame, label: str, entries: dict[str, dict[str, Column]]) -> DataFrame:
    """One row per entry: its name under ``label`` plus its named columns."""
    structs = [F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in cols.items()])
               for name, cols in entries.items()]
    return df.select(F.inline(F.array(*structs)))


def melt(df: DataFrame, columns: list[str]) -> DataFrame:
    """(slot, value) for every present, numeric value; slot is the column's position.

    Grouping by a small integer is cheaper than by a name; slot_name() turns
    it back once the rows are few.
    """
    cells = [F.struct(F.lit(i).alias("slot"), F.col(c).cast("double").alias("value"))
             for i, c in enumerate(columns)]
    return (df.select(F.inline(F.array(*cells)))
            .where("value is not null and not isnan(value)"))


def slot_name(columns: list[str], slot: str = "slot") -> Column:
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col(slot))
