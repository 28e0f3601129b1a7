"""Distribution statistics: correlation matrix, summary, histograms, exact percentiles."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Row, Window, functions as F

from heatmart.functions.numeric import no_nan, round_to
from heatmart.operators.scale import cut_lineage
from heatmart.operators.shape import melt, to_rows

# Measures of the correlation matrix, and those drawn as histograms.
CORRELATED = ["temperature_moyenne", "temperature_maximale", "temperature_minimale",
              "humidite_moyenne", "precipitations_totales", "vitesse_vent_moyenne",
              "pression_moyenne", "duree_ensoleillement"]
DRAWN = ["temperature_moyenne", "temperature_maximale", "humidite_moyenne",
         "vitesse_vent_moyenne", "pression_moyenne", "duree_ensoleillement"]


def correlation_matrix(df: DataFrame, columns: list[str] = CORRELATED) -> DataFrame:
    """Pearson correlation of every pair of columns, over rows where both are present.

    Rows are grouped by which columns they lack. Within such a pattern every
    pair is complete, so one pass gives sums and products of each, and at most
    two to the number of columns rows come back. Sums are taken from a value
    near the mean, where products lose no digits. An undefined correlation is
    NULL. Starts the pass when called.
    """
    k = len(columns)
    values = df.select(*[no_nan(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)])
    # any value will do as origin, the nearer to the mean the better
    near = values.limit(1000).agg(*[F.coalesce(F.avg(F.when(F.abs(c) < math.inf, F.col(c))), F.lit(0.0)) for c in values.columns]).first()
    pattern = sum((F.col(c).isNull().cast("int") * (1 << i) for i, c in enumerate(values.columns)), F.lit(0))
    moved = values.select(pattern.alias("pattern"), *[F.coalesce(F.col(c) - F.lit(o), F.lit(0.0)).alias(c)
                                                      for c, o in zip(values.columns, near)])
    pairs = list(combinations_with_replacement(range(k), 2))
    found = moved.groupBy("pattern").agg(
        F.count("*").alias("n"), *[F.sum(f"v{i}").alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"p{i}_{j}") for i, j in pairs]).collect()

    def correlated(i: int, j: int) -> float | None:
        both = [r for r in found if not r["pattern"] & (1 << i | 1 << j)]
        n = sum(r["n"] for r in both)
        if n < 2:
            return None
        def total(name: str) -> float:
            return sum(r[name] for r in both)
        x, y = total(f"s{i}"), total(f"s{j}")
        spread = [total(f"p{a}_{a}") - t * t / n for a, t in ((i, x), (j, y))]
        # what cancels down to the last digits is a constant column
        if any(not v > 1e-14 * total(f"p{a}_{a}") for a, v in zip((i, j), spread)):
            return None
        r = (total(f"p{i}_{j}") - x * y / n) / math.sqrt(spread[0]) / math.sqrt(spread[1])
        return 1.0 if i == j and math.isfinite(r) else r if math.isfinite(r) else None

    grid = [(columns[i], columns[j], correlated(min(i, j), max(i, j))) for i in range(k) for j in range(k)]
    return df.sparkSession.createDataFrame(grid, "variable_1 string, variable_2 string, r double")


def histograms(df: DataFrame, columns: list[str] = DRAWN, bins: int = 60) -> DataFrame:
    """Equal-width histograms, empty bins included; the last bin holds the maximum.

    A column with a single value is centred in a range of width one.
    """
    row = df.agg(*[a(no_nan(F.col(c).cast("double"))).alias(f"{n}_{c}")
                   for c in columns for n, a in (("lo", F.min), ("hi", F.max))])
    ends = to_rows(row, "variable", {
        c: {"slot": F.lit(i), "lo": F.col(f"lo_{c}"), "hi": F.col(f"hi_{c}")}
        for i, c in enumerate(columns)})
    flat = F.col("lo") == F.col("hi")
    ends = ends.where("lo is not null").select(
        "variable", "slot", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    place = F.floor(bins * (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo"))) + 1
    # one row of bounds per column: its size is the number of columns
    counts = (melt(df, columns).join(F.broadcast(ends.drop("variable")), "slot")
              .groupBy("slot", F.least(place, F.lit(bins)).cast("int").alias("bin"))
              .agg(F.count("*").alias("n")))
    width = (F.col("hi") - F.col("lo")) / bins
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return grid.join(counts, ["slot", "bin"], "left").select(
        "variable", "bin", (F.col("lo") + width * (F.col("bin") - 1)).alias("lower"),
        (F.col("lo") + width * F.col("bin")).alias("upper"), F.coalesce("n", F.lit(0)).alias("n"))


def between(low: float, high: float, part: float) -> float:
    """Linear interpolation; an infinite end pulls everything between to itself, the lower one first."""
    if low == high or part == 0:
        return low
    if math.isinf(low) or math.isinf(high):
        return low if math.isinf(low) else high
    return low + (high - low) * part if math.isfinite(high - low) else low * (1 - part) + high * part


def _brackets(ends: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Ranges in ascending order, overlapping ones joined."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(ends):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def _located(df: DataFrame, columns: list[str], ranges: dict[int, list[tuple[float, float]]]) -> tuple[DataFrame, dict]:
    """(cell, value, copies) of the values inside the ranges, written down; and the number of values of each cell.

    A column's cells count up its line: an even one lies before, between or
    after its ranges, an odd one is a range. Values outside of them are only
    counted, in the task that reads them.
    """
    slots, step = [], 2 * max(map(len, ranges.values())) + 1
    for slot, own in ranges.items():
        v = no_nan(F.col(columns[slot]).cast("double"))
        place = F.lit(2 * len(own))
        for i, (lo, hi) in reversed(list(enumerate(own))):
            place = F.when(v < lo, 2 * i).when(v <= hi, 2 * i + 1).otherwise(place)
        # zero added: one zero for both signs
        slots.append(F.struct((F.lit(slot * step) + place).alias("cell"),
                              F.when(place % 2 == 1, v + 0.0).alias("value"), v.isNotNull().alias("there")))
    cells = df.select(F.inline(F.array(*slots))).where("there").groupBy("cell", "value").agg(F.count("*").alias("copies"))
    found = cut_lineage(cells)
    counts = {(r["cell"] // step, r["cell"] % step): r["n"] for r in found.groupBy("cell").agg(F.sum("copies").alias("n")).collect()}
    return found.where("value is not null").withColumn("slot", F.floor(F.col("cell") / step).cast("int")), counts


def percentiles(df: DataFrame, columns: list[str], shares: list[float],
                fan_out: int = 4096, accuracy: int = 10_000) -> DataFrame:
    """Exact percentiles with linear interpolation: (variable, share, value).

    percentile() gathers all distinct values of a column in one task. Here a
    first pass makes mergeable sketches, which bracket each rank to some
    ``accuracy``-th parts of the values. A second pass counts what lies below
    each bracket and writes down, with their numbers, only the values inside.
    From that small table each rank is narrowed down: count ``fan_out`` equal
    slices of its current range, step into the slice holding the rank, until
    that holds one value. Only bounds, a few rows per rank, come back to the
    driver. Should a sketch miss a rank, its column is counted whole.
    """
    spark = df.sparkSession
    around = sorted({min(max(s + e * 3 / accuracy, 0.0), 1.0) for s in shares for e in (-1, 1)})
    values = [no_nan(F.col(c).cast("double")) for c in columns]
    sketch = df.agg(*[a for i, v in enumerate(values) for a in (
        F.count(v).alias(f"n{i}"), F.percentile_approx(v, around, accuracy).alias(f"a{i}"))]).first()
    size = {i: sketch[f"n{i}"] for i in range(len(columns)) if sketch[f"n{i}"]}

    def neighbours(slot: int, share: float) -> tuple[int, int, float]:
        at = share * (size[slot] - 1)
        return math.floor(at), math.ceil(at), at - math.floor(at)

    def bracket(slot: int, share: float) -> tuple[float, float]:
        lo, hi = (sketch[f"a{slot}"][around.index(min(max(share + e * 3 / accuracy, 0.0), 1.0))] for e in (-1, 1))
        return (-math.inf if share <= 3 / accuracy else lo), (math.inf if share >= 1 - 3 / accuracy else hi)

    ranges = {slot: _brackets([bracket(slot, s) for s in shares]) for slot in size}
    wanted_ranks = {(slot, rank) for slot in size for s in shares for rank in neighbours(slot, s)[:2]}
    while ranges:
        counted, counts = _located(df, columns, ranges)
        found_in: dict[tuple[int, int], tuple[int, int]] = {}
        for slot, rank in wanted_ranks:
            before = 0
            for place in range(2 * len(ranges[slot]) + 1):
                here = counts.get((slot, place), 0)
                if rank < before + here:
                    found_in[slot, rank] = place, before
                    break
                before += here
        missed = {slot for (slot, _), (place, _) in found_in.items() if place % 2 == 0}
        if not missed:
            break
        ranges.update({slot: [(-math.inf, math.inf)] for slot in missed})

    held: dict[tuple[int, int], tuple[float, float, int]] = {}
    if ranges:
        finite = F.when(F.abs("value") < math.inf, F.col("value"))
        step = 2 * max(map(len, ranges.values())) + 1
        extent = {r["cell"]: r for r in counted.groupBy("cell").agg(
            F.sum("copies").alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi"),
            F.coalesce(F.sum(F.when(F.col("value") == -math.inf, F.col("copies"))), F.lit(0)).alias("below"),
            F.coalesce(F.sum(F.when(F.col("value") == math.inf, F.col("copies"))), F.lit(0)).alias("above"),
        ).collect()}

        def started(slot: int, rank: int) -> tuple[float, float, int]:
            """Infinite values are ranked by their number, finite ones searched."""
            place, before = found_in[slot, rank]
            row = extent[slot * step + place]
            if rank < before + row["below"]:
                return -math.inf, -math.inf, before
            if rank >= before + row["n"] - row["above"]:
                return math.inf, math.inf, before + row["n"] - row["above"]
            return row["lo"], row["hi"], before + row["below"]

        # range that still holds each (slot, rank): lowest value, highest value, values below it
        held = {(slot, rank): started(slot, rank) for slot, rank in wanted_ranks}
    while True:
        open_ = sorted({(slot, *r) for (slot, _), r in held.items() if r[0] < r[1]})
        if not open_:
            break
        asked = spark.createDataFrame(
            [(i, s, lo, hi) for i, (s, lo, hi, _) in enumerate(open_)],
            "range int, slot int, lo double, hi double")
        wanted = spark.createDataFrame(
            [(open_.index((s, *r)), r[2], rank) for (s, rank), r in held.items() if r[0] < r[1]],
            "range int, before long, rank long")
        inside = counted.drop("cell").join(F.broadcast(asked), "slot").where(
            F.col("value").between(F.col("lo"), F.col("hi")))
        # halves, where the whole width would overflow
        wide = F.col("hi") / 2 - F.col("lo") / 2 > 8e307
        part = F.when(wide, (F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)).otherwise(
            (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        piece = F.floor(F.lit(float(fan_out)) * part)
        slices = (inside.groupBy("slot", "range", piece.alias("slice"))
                  .agg(F.sum("copies").alias("n"), F.min("value").alias("lo"),
                       F.max("value").alias("hi")))
        # a window group holds at most fan_out + 1 slices
        running = F.sum("n").over(Window.partitionBy("slot", "range").orderBy("slice"))
        sums = slices.withColumn("upto", running)
        below = F.col("before") + F.col("upto") - F.col("n")
        found = (sums.join(F.broadcast(wanted), "range")
                 .where((F.col("rank") >= below) & (F.col("rank") < below + F.col("n")))
                 .select("slot", "rank", "lo", "hi", below.alias("before")))
        before = dict(held)
        for r in found.collect():
            held[r["slot"], r["rank"]] = (r["lo"], r["hi"], r["before"])
        if held == before:
            raise RuntimeError("a range of values could not be narrowed down")

    rows = []
    for slot, variable in enumerate(columns):
        for share in shares:
            value = None
            if slot in size:
                low, high, part = neighbours(slot, share)
                value = held[slot, low][0]
                value = between(value, held[slot, high][0], part)
            rows.append((variable, share, value))
    return spark.createDataFrame(rows, "variable string, share double, value double")


def summary(panel: DataFrame, columns: list[str] = CORRELATED, digits: int = 2) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the measures, year and month."""
    dated = panel.withColumn("annee", F.year("date")).withColumn("mois", F.month("date"))
    columns = [*columns, "annee", "mois"]
    moments = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = dated.agg(*[f(no_nan(F.col(c).cast("double"))).alias(f"{c}|{n}")
                      for c in columns for n, f in moments.items()])
    wide = to_rows(row, "variable", {c: {n: F.col(f"`{c}|{n}`") for n in moments}
                                     for c in columns})
    quartiles = (percentiles(dated, columns, [0.25, 0.5, 0.75]).groupBy("variable")
                 .pivot("share", [0.25, 0.5, 0.75]).agg(F.first("value"))
                 .toDF("variable", "p25", "p50", "p75"))
    joined = wide.join(F.broadcast(quartiles), "variable")
    figures = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return joined.select("variable", "count",
                         *[round_to(F.col(c), digits).alias(c) for c in figures])
