"""Fingerprints of texts by closed syncmers of words, in SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# An anchor is a run of K words in which the smallest hash of its runs of S
# words is the first or the last; one run in (K - S + 1) / 2 is an anchor.
K = 8
S = 2
# Texts per range when texts are lined up by id, and most ranges; beyond, ranges grow.
RANGE_ROWS = 2_000
RANGES = 4_096


def _let(value: Column, then) -> Column:
    """then(value), with value worked out once per row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<hash: long, pos: int>> of a text's anchors in order; pos is the anchor's first word.

    Words are parted by blanks, tabs and line ends. An anchor depends on its
    own words alone, whatever stands around them. A text of fewer than k words
    has one anchor, all its words; a text without words (NULL, empty) none.
    """
    def of(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        inner = _let(hashes, lambda h: F.transform(F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(
            *[F.get(h, i + j) for j in range(s)])))

        def chosen(m: Column) -> Column:
            last = k - s
            least = lambda i: F.array_min(F.slice(m, i + 1, last + 1))
            at = F.filter(F.sequence(F.lit(0), n - k), lambda i: _let(least(i), lambda x: (
                F.get(m, i) == x) | (F.get(m, i + last) == x)))
            return F.transform(at, lambda i: F.struct(
                short(F.array_join(F.slice(w, i + 1, k), " ")), i.alias("pos")))

        whole = F.array(F.struct(short(F.array_join(w, " ")), F.lit(0).alias("pos")))
        return F.when(n >= k, _let(inner, chosen)).when(n > 0, whole).otherwise(F.slice(whole, 1, 0))

    def short(run: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(run), 32).alias("hash")

    split = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), "\t\n\r\f\x0b", "     "), " "), lambda x: x != "")
    return _let(split, of)


def slim(found: Column) -> Column:
    """Anchors as struct<hash: array<int>, pos: array<int>>, a quarter of the size in a shuffle."""
    return _let(found, lambda a: F.struct(
        F.transform(a, lambda e: (e["hash"] - 2 ** 31).cast("int")).alias("hash"),
        F.transform(a, lambda e: e["pos"]).alias("pos")))


def fingerprint(found: Column) -> Column:
    """Slim anchors as text: hash, a point, and the place of the first word, parted by blanks."""
    return F.array_join(F.transform(found["hash"], lambda h, i: F.concat(
        F.lpad(F.lower(F.hex(h.cast("long") + 2 ** 31)), 8, "0"), F.lit("."), F.get(found["pos"], i).cast("string"))), " ")


def likeness(left: Column, right: Column) -> Column:
    """Share of different (slim) anchors that two texts have in common, 0 to 1 (Dice); 1 if neither has any."""
    a, b = (F.array_distinct(x["hash"]) for x in (left, right))
    return _let(F.struct(a.alias("a"), b.alias("b")), lambda p: F.when(
        F.size(p["a"]) + F.size(p["b"]) == 0, F.lit(1.0)).otherwise(
        F.lit(2.0) * F.size(F.array_intersect(p["a"], p["b"])) / (F.size(p["a"]) + F.size(p["b"]))))


def aligned(left: Column, right: Column) -> Column:
    """array<struct<hash, pos, other>>: anchors of left with the place of their first match in right."""
    places = F.map_from_entries(F.transform(
        F.array_distinct(F.transform(right, lambda e: e["hash"])),
        lambda h: F.struct(h, F.element_at(F.filter(right, lambda e: e["hash"] == h), 1)["pos"])))
    return _let(places, lambda m: F.filter(
        F.transform(left, lambda e: F.struct(e["hash"].alias("hash"), e["pos"].alias("pos"), F.element_at(m, e["hash"]).alias("other"))),
        lambda e: e["other"].isNotNull()))


def with_next(docs: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """docs plus ``next``, a struct of the columns of the row with the next id (the first row's, after the last).

    Rows are lined up by ranges of ids, a range a window; the row after a
    range's last is the first one of the next range, found by ids alone. NULL
    ids come first, rows with equal ids in the order of the columns.
    """
    ids = docs.select(id_col)
    n = ids.count()
    count = min(max(1, n // RANGE_ROWS), RANGES)
    cuts = sorted(set(ids.where(F.col(id_col).isNotNull()).approxQuantile(
        id_col, [i / count for i in range(1, count)], 0.2 / count))) if count > 1 else []
    cuts = F.array(*[F.lit(int(c)).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    part = F.coalesce(F.size(F.filter(cuts, lambda c: c <= F.col(id_col))), F.lit(0))
    rows = docs.withColumn("__part", part).withColumn("__own", F.struct(*columns))
    order = [F.col(id_col).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in columns]]
    mine = Window.partitionBy("__part").orderBy(*order)
    rows = rows.withColumn("__next", F.lead("__own").over(mine))
    # The ranges' first rows: one row each, pre-aggregated by task.
    heads = docs.groupBy(part.alias("__part")).agg(F.min(F.struct(id_col, *columns)).alias("__first"))
    line = Window.partitionBy(F.lit(0)).orderBy("__part")
    start = F.first("__first").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("__part", F.coalesce(F.lead("__first").over(line), start).alias("__head"))
    after = F.when(F.col("__next").isNotNull(), F.col("__next")).otherwise(
        F.struct(*[F.col("__head")[c].alias(c) for c in columns]))
    return rows.join(heads, "__part").withColumn("next", after).drop("__part", "__own", "__next", "__head")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) characters replaced by the
    first as many (or all) of the next text by id. NULL counts as empty. An
    empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("anchors", slim(anchors(F.col("text")))), id_col, ["text", "anchors"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.col("next.text"), F.lit(1), half))
    rows = rows.select(F.col(id_col), F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "anchors",
                       F.col("next.anchors").alias("others"))
    # One lambda binds what is used several times.
    found = _let(slim(anchors(F.col("edited"))), lambda e: F.struct(
        fingerprint(e).alias("edited_fingerprint"), likeness(F.col("anchors"), e).alias("near_edited")))
    return rows.select(
        id_col, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("anchors")).alias("fingerprint"),
        found.alias("found"), likeness(F.col("anchors"), F.col("others")).alias("near_next")).select(
        id_col, "n_chars", "edited_sha256", "fingerprint", "found.edited_fingerprint", "found.near_edited", "near_next")
