"""Hard negatives: for each anchor and each of its positives, the best rows of other labels within a band of scores.

The upper ends of an anchor's bands, one per positive, cut the scores into
disjoint slots, so every row of another label belongs to at most one slot. A
task keeps the best few rows of each slot while it streams its rows past a
block of anchors, and the cluster merges what the tasks kept. A positive's
band is a run of slots, from its own downwards: merging them in descending
order answers all overlapping bands from the same few rows.

Anchors are a stated query set: they travel to the tasks in blocks of bounded
size, and the rows, stored once, are read twice per block (for positives, then
for negatives) and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from heatmart.llm.common import drop, stored

# Bytes of anchor vectors that are sent to the tasks at a time.
BLOCK = 32 << 20
# Scores that a task has in memory at a time.
SCORES = 1 << 22
LONG = 2 ** 63 - 1


class Anchors:
    """A block of anchors; vectors of each length as one matrix."""

    def __init__(self, rows: pa.Table) -> None:
        self.key = rows.column("key").to_numpy()
        self.id = rows.column("id").to_numpy()
        self.label = rows.column("label").to_numpy()
        self.of_length = matrices(rows.column("vector").combine_chunks())


def matrices(vectors: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length."""
    length = vectors.value_lengths().to_numpy()
    ends = np.concatenate([[0], np.cumsum(length)])
    flat = vectors.flatten().to_numpy()
    out = {}
    for n in np.unique(length).tolist():
        at = np.flatnonzero(length == n)
        out[n] = at, flat[ends[at][:, None] + np.arange(n)]
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; those beyond a long's range end there."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    most = [float(max(abs(int(m.max())), abs(int(m.min())))) for m in (a, b)]
    bound = most[0] * most[1] * a.shape[1]
    if bound < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound < 2 ** 63:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64)


class Best:
    """The best ``keep`` rows of each cell: higher scores first, then smaller ids."""

    def __init__(self, cells: int, keep: int) -> None:
        self.keep = keep
        self.cell = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        # lowest score that can still get into a cell
        self.least = np.full(cells, -LONG - 1, np.int64)

    def offer(self, cell: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        hopeful = score >= self.least[cell]
        if not hopeful.any():
            return
        cell = np.concatenate([self.cell, cell[hopeful]])
        score = np.concatenate([self.score, score[hopeful]])
        ids = np.concatenate([self.id, ids[hopeful]])
        # ~score turns the order round without overflow
        order = np.lexsort((ids, ~score, cell))
        cell = cell[order]
        first = np.searchsorted(cell, cell)
        kept = np.arange(len(cell)) - first < self.keep
        last = np.arange(len(cell)) - first == self.keep - 1
        self.cell, self.score, self.id = cell[kept], score[order][kept], ids[order][kept]
        self.least[cell[last]] = score[order][last]


def _scored(anchors: Anchors, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of scores: anchors (by number), ids and labels of rows, matrix of scores."""
    for batch in batches:
        ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for length, (rows, vectors) in matrices(batch.column(2)).items():
            if length not in anchors.of_length:
                continue
            mine, asked = anchors.of_length[length]
            step = max(SCORES // len(mine), 1)
            for i in range(0, len(rows), step):
                at = rows[i:i + step]
                yield mine, ids[at], labels[at], inner(asked, vectors[i:i + step])


KEPT = "key long, slot int, score long, id long"


def _kept(best: Best, key: np.ndarray, slots: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key[best.cell // slots]), pa.array((best.cell % slots).astype(np.int32)), pa.array(best.score), pa.array(best.id)],
        ["key", "slot", "score", "id"])


def _positives(rows: DataFrame, shared, k: int) -> DataFrame:
    """The best k rows of a task with an anchor's label, its own id left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        best = Best(len(anchors.key), k)
        for mine, ids, labels, scores in _scored(anchors, batches):
            alike = anchors.label[mine][:, None] == labels
            alike &= scores >= best.least[mine][:, None]
            a, b = np.nonzero(alike)
            other = anchors.id[mine[a]] != ids[b]
            a, b = a[other], b[other]
            best.offer(mine[a], scores[a, b], ids[b])
        yield _kept(best, anchors.key, 1)
    return rows.mapInArrow(run, KEPT)


def _negatives(rows: DataFrame, shared, n: int, limits) -> DataFrame:
    """The best n rows of a task in each slot of an anchor.

    ``limits`` has an anchor's upper ends, descending, a row per anchor, and
    the lowest lower end; slot j lies above the j+1st upper end and not above
    the jth.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, (upper, lowest) = shared.value, limits.value
        slots = upper.shape[1]
        best = Best(len(anchors.key) * slots, n)
        for mine, ids, labels, scores in _scored(anchors, batches):
            fit = anchors.label[mine][:, None] != labels
            fit &= (scores <= upper[mine, :1]) & (scores >= lowest[mine][:, None])
            a, b = np.nonzero(fit)
            score, anchor = scores[a, b], mine[a]
            slot = np.zeros(len(a), np.int64)
            for j in range(1, slots):
                slot += score <= upper[anchor, j]
            best.offer(anchor * slots + slot, score, ids[b])
        yield _kept(best, anchors.key, slots)
    return rows.mapInArrow(run, KEPT)


def _merged(kept: DataFrame, n: int) -> DataFrame:
    """The best n of each (anchor, slot) over all tasks, ranked from 1."""
    order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "id")
    return kept.withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= n)


def hard_negatives(rows: DataFrame, anchor, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has a whole-number id and label and an array<long> of whole
    numbers; ``anchor`` is the condition on rows that makes one an anchor. A
    score is the inner product; products beyond a long end at its range.
    Higher scores come first, then smaller ids. An anchor's positives are its
    first rows of the same label and another id. For each, the first rows of
    another label with low * positive <= 100 * negative <= high * positive
    are returned, rank 1 first; none, if a positive score is negative and low
    is below high.

    Rows with NULL id, label or vector, or a NULL component, take no part.
    Vectors of different lengths have no score with each other; empty ones
    score 0. Rows that share an id are rows of their own, never each other's
    positives; an anchor that occurs twice gets its rows twice. Other columns
    may have any names. Without anchors, positives or negatives there are no
    rows. A task holds a block of anchors, SCORES scores and a few rows of
    each slot.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vector_col).cast("array<long>").alias("vector"),
                       F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows, seen = stored(rows.where("id is not null and label is not null and vector is not null and not exists(vector, x -> x is null)"),
                        longest=F.max(F.size("vector")), asked=F.count_if("anchor"))
    asked = rows.where("anchor").select(F.monotonically_increasing_id().alias("key"), "id", "label", "vector")
    rows = rows.select("id", "label", "vector")
    per_block = max(BLOCK // (8 * max(seen["longest"] or 0, 1) + 64), 1)
    count = -(-(seen["asked"] or 0) // per_block) or 1
    # a stored table keeps its order of rows, so each anchor has its number in every reading
    asked, _ = stored(asked)
    done = None
    for b in range(count):
        block = Anchors(asked.where(F.pmod(F.xxhash64("key"), F.lit(count)) == b).toArrow())
        shared = spark.sparkContext.broadcast(block)
        found, at = stored(_merged(_positives(rows, shared, positives), positives))
        # at most as many rows as positives times the block's anchors
        chosen = found.select("key", "nr", "score").toArrow()
        limits = spark.sparkContext.broadcast(_limits(block, chosen, positives, low, high))
        kept, path = stored(_merged(_negatives(rows, shared, negatives, limits), negatives))
        part = _answered(found, kept, asked, positives, negatives, low, high)
        answer, _ = stored(part)
        for old in (at, path):
            drop(spark, old["path"])
        done = answer if done is None else done.union(answer)
    return done


def _limits(block: Anchors, chosen: pa.Table, positives: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper ends of each anchor's bands, descending, and the lowest lower end; the anchors in the block's order."""
    by = np.argsort(block.key)
    at = by[np.searchsorted(block.key, chosen.column("key").to_numpy(), sorter=by)]
    upper = np.full((len(block.key), positives), -LONG - 1, np.int64)
    lowest = np.full(len(block.key), LONG, np.int64)
    if len(at):
        # whole numbers of any size: 95 times a long may not be one
        score = chosen.column("score").to_numpy().astype(object)
        ends = np.clip(score * high // 100, -LONG - 1, LONG).astype(np.int64)
        starts = np.clip(-(-score * low // 100), -LONG - 1, LONG).astype(np.int64)
        upper[at, chosen.column("nr").to_numpy() - 1] = ends
        np.minimum.at(lowest, at, starts)
    return upper, lowest


def _answered(found: DataFrame, kept: DataFrame, asked: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Suffix merges: the best rows of a positive's own slot and those below, down to its lower end.

    An anchor has at most positives * negatives kept rows.
    """
    mine = found.select("key", F.col("nr").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    slots = kept.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
        "slot", (-F.col("nr")).alias("back"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))).alias("best"))
    # slots ascend as scores descend, and within a slot the rank does: sorted by (slot, rank) is sorted by score
    suffix = F.expr(f"""slice(array_sort(filter(best, b -> b.slot >= place - 1),
        (x, y) -> case when x.slot <> y.slot then x.slot - y.slot else y.back - x.back end), 1, {negatives})""")
    wide = "decimal(38,0)"
    inside = (F.col("negative_score").cast(wide) * 100 >= F.col("positive_score").cast(wide) * low) & (
        F.col("negative_score").cast(wide) * 100 <= F.col("positive_score").cast(wide) * high)
    return (mine.join(slots, "key").select("key", "positive_id", "positive_score", F.posexplode(suffix).alias("at", "b"))
            .select("key", "positive_id", "positive_score", "at", "b.negative_id", "b.negative_score").where(inside)
            .join(asked.select("key", F.col("id").alias("anchor_id")), "key")
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))
