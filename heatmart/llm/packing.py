"""Packing texts into batches: buckets of lengths with least padding, batches of a token budget."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from heatmart.llm.common import stored

BUCKETS = 16
TOKENS = 65_536


def word_count(text: Column) -> Column:
    """Number of runs of other characters than white space."""
    trimmed = F.regexp_replace(text, r"^[ \t-\r]+|[ \t-\r]+$", "")
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.lit(0)).otherwise(
        F.size(F.split(trimmed, r"[ \t-\r]+"))).cast("long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding.

    Dynamic programming over the sorted distinct lengths; the cost of a bucket
    fulfils the quadrangle inequality, so best cuts move one way and each layer
    is solved by halving, all ranges of a level at once. Sums are whole numbers.
    """
    n = len(lengths)
    if not n:
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    best = lengths * total[1:]  # padded size of lengths 0..i in one bucket
    cuts = [np.zeros(n, np.int64)]
    for _ in range(1, min(buckets, n)):
        new, cut = best.copy(), np.zeros(n, np.int64)
        lo, hi, first, last = (np.array([x]) for x in (1, n - 1, 1, n - 1))
        while len(lo):
            mid = (lo + hi) // 2
            size = np.minimum(mid, last) - first + 1
            at = np.cumsum(size) - size
            k = np.arange(int(size.sum())) + np.repeat(first - at, size)  # the last bucket is k..mid
            end = np.repeat(mid, size)
            cost = best[k - 1] + lengths[end] * (total[end + 1] - total[k])
            least = np.minimum.reduceat(cost, at)
            hits = np.flatnonzero(cost == np.repeat(least, size))
            chosen = k[hits[np.searchsorted(hits, at)]]
            new[mid], cut[mid] = least, chosen
            lo, hi, first, last = (np.concatenate(x) for x in (
                (lo, mid + 1), (mid - 1, hi), (first, chosen), (chosen, last)))
            some = lo <= hi
            lo, hi, first, last = lo[some], hi[some], first[some], last[some]
        cuts.append(cut)
        best = new
    ends, i = [], n - 1
    for cut in reversed(cuts):
        ends.append(int(lengths[i]))
        if cut[i] == 0:
            break
        i = int(cut[i]) - 1
    return ends[::-1]


def packed(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None,
           buckets: int = BUCKETS, tokens: int = TOKENS) -> DataFrame:
    """One row per input row: id, n_tokens, bucket, padded (its length in the batch), batch, place.

    The histogram of lengths covers all rows and alone goes to the driver: d
    different lengths need d(d+1)/2 tokens at least, so 2e13 tokens have fewer
    than 6.4 million, 16 bytes each. A batch holds as many rows as the token
    budget takes at its bucket's padded length, one at least. Rows are numbered
    when lengths are written, and within (bucket, slice), slices being hashes of
    those numbers; the slices' sizes, summed up, turn that into places in the
    bucket. So neither a bucket with most rows nor equal rows are one task's work.

    Texts without words (NULL, empty) have no tokens and form a bucket of
    padded length 0, in batches of ``tokens`` rows. A NULL id is packed like
    any other; equal rows take places in any order. An empty table gives an
    empty result; further columns don't matter. ``length`` gives other lengths
    than the number of words in ``text``.
    """
    length = word_count(F.col("text").cast("string")) if length is None else length
    rows = docs.select(F.col(id_col), F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"))
    # Lengths are worked out once, and written without the texts.
    rows, _ = stored(rows.withColumn("__row", F.monotonically_increasing_id()))
    counted = rows.groupBy("n_tokens").count().toArrow().sort_by("n_tokens")
    lengths, counts = (counted.column(c).to_numpy() for c in ("n_tokens", "count"))
    some = lengths > 0
    ends = ([0] if not some.all() else []) + boundaries(lengths[some], counts[some], buckets)
    if not ends:
        ends = [0]
    # About 16,000 rows a slice.
    slices = max(1, int(counts.sum()) >> 14)
    each = F.array(*[F.lit(e).cast("long") for e in ends])
    bucket = F.size(F.filter(each, lambda e: e < F.col("n_tokens"))).alias("bucket")
    rows = rows.select(id_col, "n_tokens", "__row", bucket, F.pmod(F.xxhash64("__row"), F.lit(slices)).alias("slice"))
    order = Window.partitionBy("bucket", "slice").orderBy("n_tokens", id_col, "__row")
    numbered = rows.withColumn("at", F.row_number().over(order) - 1)
    sizes = rows.groupBy("bucket", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    padded = F.element_at(each, F.col("bucket") + 1)
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(tokens) / F.greatest(padded, F.lit(1)))).cast("long")
    place = F.col("offset") + F.col("at")
    return numbered.join(offsets, ["bucket", "slice"]).select(
        id_col, "n_tokens", F.col("bucket").cast("long").alias("bucket"), padded.alias("padded"),
        F.floor(place / per_batch).cast("long").alias("batch"), (place % per_batch).cast("long").alias("place"))
