"""License notices in texts: MinHash bands over windows find templates, shingle containment confirms them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heatmart.llm.common import stored

# Opening lines of public licenses, fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
)
# Words per shingle, per window and from window to window. Any run of
# WINDOW - STEP + 1 words lies within one window.
SHINGLE = 2
WINDOW = 12
STEP = 6
# Bands of one coordinate each: a window that shares a third of its shingles
# with a template's stretch is found with probability 1 - (2/3)^24 > 0.9999.
BANDS = 24
CONTAINED = 0.8


def tokens(text: Column) -> Column:
    """Runs of a-z and 0-9, A-Z lower-cased."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, "[^a-z0-9]+"), lambda x: x != "")


def _let(value: Column, then) -> Column:
    return F.element_at(F.transform(F.array(value), then), 1)


def shingles(words: Column) -> Column:
    """array<long>: a hash per run of SHINGLE words, in order; fewer words make one."""
    return _let(F.transform(words, lambda x: F.xxhash64(x)), lambda h: F.when(F.size(h) == 0, h).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(h) - SHINGLE, F.lit(0))),
        lambda i: F.xxhash64(*[F.coalesce(F.get(h, i + j), F.lit(0).cast("long")) for j in range(SHINGLE)]))))


def bands(window: Column) -> Column:
    """array<struct<band, value>>: the smallest hash of each coordinate."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(window, lambda x: F.xxhash64(x, b))).alias("value")))


def templates(spark: SparkSession, texts: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, license, words, shingles) of the given notices; a list on the driver, so bounded by its source."""
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(texts)], "template int, license string, notice string")
    return rows.withColumn("words", F.size(tokens(F.col("notice")))).withColumn("shingles", F.array_distinct(shingles(tokens(F.col("notice")))))


def crowded(words: int, different: int) -> int:
    """Shingles of a notice that some window holds, wherever a run holds CONTAINED of its different ones.

    A run of a quarter more words falls into pieces that each lie within one
    window; one of them has at least the average.
    """
    piece = WINDOW - STEP + 1 - SHINGLE + 1
    pieces = -(-max(math.ceil(words * 1.25) - SHINGLE + 1, 1) // piece)
    return max(math.ceil(math.ceil(CONTAINED * different - 1e-9) / pieces), 1)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 texts: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per input row and notice found: id, template, license, containment, n_places.

    A notice is found where some run of words, a quarter longer than the
    notice, holds CONTAINED of its different shingles; containment is the most
    that any run holds, n_places the number of first words of such runs.

    Windows of a text and of the templates meet by equal MinHash values in any
    of BANDS bands. A run that holds enough of a notice has a window with
    crowded() shingles of it, so signatures are worked out for windows with as
    many shingles of any template; whole texts are read. Only those windows
    and the places of template shingles are kept of a text. NULL and empty
    texts have no notices; a NULL id is reported as it is; equal rows are
    reported alike, each for itself; without rows there are no notices. Other
    columns may have any names.
    """
    spark = docs.sparkSession
    known = templates(spark, texts)
    # The templates' shingles come from a list in the code: a bounded set.
    lists = known.select("words", "shingles").collect()
    listed = sorted({s for r in lists for s in r["shingles"]})
    need = min((crowded(r["words"], len(r["shingles"])) for r in lists), default=1)
    size = WINDOW - SHINGLE + 1
    rows = docs.select(F.col(id_col).alias("id"), shingles(tokens(F.col(text_col).cast("string"))).alias("s"))
    hit = F.filter(F.transform(F.col("s"), lambda x, i: F.when(x.isin(listed), i)), lambda i: i.isNotNull())
    # the row number also keeps the filters above from working the hits out a second time
    rows = rows.select("id", F.monotonically_increasing_id().alias("row"), "s", hit.alias("hit")).where(F.size("hit") >= need)

    def around(i: Column, j: Column) -> Column:
        """Windows that hold this hit and the next ones, ``need`` in all."""
        last = F.get(F.col("hit"), j + (need - 1))
        lo = F.greatest(F.ceil((last - size + 1) / STEP), F.lit(0)).cast("int")
        hi = F.floor(i / STEP).cast("int")
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    windows = F.array_distinct(F.flatten(F.transform("hit", around)))
    rows = rows.withColumn("w", windows).where(F.size("w") > 0)
    # of the texts only stretches around hits go on
    rows, _ = stored(rows.select(
        "id", "row",
        F.transform("hit", lambda i: F.struct(i.alias("i"), F.get(F.col("s"), i).alias("s"))).alias("hits"),
        F.transform("w", lambda w: F.slice(F.col("s"), w * STEP + 1, size)).alias("cuts")))
    seen = rows.select("row", F.explode("cuts").alias("cut")).select("row", F.explode(bands(F.col("cut"))).alias("b"))
    stretch = WINDOW - STEP + 1 - SHINGLE + 1
    of_template = known.select("template", F.col("shingles").alias("s")).select("template", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("s") - stretch + 1, F.lit(1))), lambda i: F.slice(F.col("s"), i, stretch))).alias("cut"))
    posted = of_template.select("template", F.explode(bands(F.col("cut"))).alias("b")).distinct()
    # the notices of the list, a few values per word: small, so the windows' values are looked up where they are made
    met = seen.join(F.broadcast(posted), "b").select("row", "template").distinct()
    pairs = rows.select("row", "id", "hits").join(met, "row").join(
        F.broadcast(known.select("template", "license", "words", F.col("shingles").alias("t"))), "template")
    # Runs that start at a shingle of the template hold as much as any other, and as many hits as they are long at most.
    span = (F.ceil(F.col("words") * 1.25) - SHINGLE + 1).cast("int")
    mine = F.filter("hits", lambda h: F.array_contains(F.col("t"), h["s"]))
    held = F.transform("mine", lambda x, j: F.size(F.array_distinct(F.transform(F.filter(
        F.slice(F.col("mine"), j + 1, span), lambda y: y["i"] < x["i"] + span), lambda y: y["s"]))) / F.size("t"))
    found = pairs.withColumn("mine", mine).select("id", "template", "license", held.alias("held")).select(
        "id", "template", "license", F.array_max("held").alias("containment"),
        F.size(F.filter("held", lambda x: x >= CONTAINED)).cast("long").alias("n_places"))
    return found.where(F.col("containment") >= CONTAINED).select(
        F.col("id").alias(id_col), F.col("template").cast("long").alias("template"), "license", "containment", "n_places")
