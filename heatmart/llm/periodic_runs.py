"""Runs: stretches of words that repeat themselves at least three times with a fixed period.

Periods are worked on by octaves. For an octave below M (16, 32, 64, ...),
boundaries lie M words apart, and a run of such a period holds a boundary c
with a whole period after it. Each text is exploded into overlapping tiles per
octave: the words around a few boundaries, from M before the first to 2 M
after the last. Tiles are dealt out and solved one by one: at each boundary a
Z-function forwards and one backwards tell how far the words repeat at every
distance of the octave. The fragments found are shuffled by text and period
and stitched where they overlap by a period.

Tiles that cannot hold a run are not made: inside a run, every eight words
from the second period on occurred at most a period before, so boundaries are
needed only near stretches of such places.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from heatmart.llm.common import byte_chunks, mix, noise, stored, word_array

# A run has at least this many words, and at least this many periods.
LEAST, TIMES = 24, 3
# Words that are compared at once to find where a tile is needed.
GRAM = 8
# The first octave has the periods below; runs of LEAST words leave no room for smaller tiles.
FIRST = 16
# Boundaries of a tile.
TILE = 8
# Words of tiles that a task solves, some seconds of work.
DEALT = 1 << 18

FOUND = "kind int, key long, id {id}, n_words long, words string, scale long, start long, first long, last long, symbols array<int>"
_GRAM = noise(GRAM, 41) | np.uint64(1)


class Chunk:
    """A run of texts as numbers, equal ones for equal words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.words, self.first = word_array(data, offsets)
        self.symbols = self.words.dictionary_encode().indices.to_numpy().astype(np.int32)
        self.n = np.diff(self.first)

    def joined(self, text: int) -> str:
        own = self.words.slice(self.first[text], self.n[text])
        return b" ".join(own.to_pylist()).decode()

    def back(self) -> np.ndarray:
        """For the eight words at each place, how far before they started last in the same text; 0 if never."""
        total = len(self.symbols) - GRAM + 1
        out = np.zeros(len(self.symbols), np.int64)
        if total <= 0:
            return out
        own = mix(self.symbols.astype(np.uint64) + np.uint64(1))
        h = np.zeros(total, np.uint64)
        for i in range(GRAM):
            h += own[i:i + total] * _GRAM[i]
        text = np.repeat(np.arange(len(self.n)), self.n)
        at = np.flatnonzero(text[:total] == text[GRAM - 1:])
        order = at[np.argsort(h[at], kind="stable")]
        same = (h[order[1:]] == h[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        out[order[1:][same]] = (order[1:] - order[:-1])[same]
        return out

    def tiles(self) -> Iterator[tuple[int, int, int, int, int, np.ndarray]]:
        """(text, scale, place of the first symbol, first and last boundary, symbols) of all tiles a run could need."""
        back = self.back()
        if not back.any():
            return
        scale = FIRST
        while TIMES * scale // 2 <= self.n.max(initial=0):
            near = np.zeros(len(back) + 2, np.int8)
            near[1:-1] = (back > 0) & (back < scale)
            edge = np.diff(near)
            a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            # a run has this many places from its second period on, see LEAST
            wide = b - a >= scale - GRAM + 1
            done: tuple[int, int] = (-1, -1)
            for a, b in zip(a[wide].tolist(), b[wide].tolist()):
                text = int(np.searchsorted(self.first, a, "right")) - 1
                lo, n = int(self.first[text]), int(self.n[text])
                c = -(-max(a - lo - scale + 1, 0) // scale)
                last = min(b - lo + GRAM - 1, n - 1) // scale
                if done[0] == text:
                    c = max(c, done[1] + 1)
                for c in range(c, last + 1, TILE):
                    end = min(c + TILE - 1, last)
                    start = max((c - 1) * scale, 0)
                    yield text, scale, start, c * scale, end * scale, self.symbols[lo + start:lo + min((end + 2) * scale, n)]
                done = (text, max(last, done[1] if done[0] == text else -1))
            scale *= 2


def z_function(s: list[int]) -> list[int]:
    """Length of the longest common prefix of s and each of its suffixes."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@lru_cache(1 << 16)
def _primes(n: int) -> tuple[int, ...]:
    """Prime divisors of n."""
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*out, n) if n > 1 else tuple(out)


def solve(symbols: list[int], scale: int, start: int, first: int, last: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of the fragments at a tile's boundaries, in words of the text.

    A fragment holds two periods at least, and its period is its smallest.
    Overlapping fragments of a tile are given as one.
    """
    at_least = 1 if scale == FIRST else scale // 2
    waiting: dict[int, tuple[int, int]] = {}
    for c in range(first - start, last - start + 1, scale):
        ahead = symbols[c:c + 2 * scale]
        forward = z_function(ahead)
        before = symbols[max(c - scale, 0):c][::-1]
        # what comes before the boundary, against what comes before each place after it
        backward = z_function(before + [-1] + symbols[max(c - scale, 0):c + scale][::-1])[len(before) + 1:]
        beyond = len(symbols[c:c + scale])
        for q in range(at_least, min(scale, len(ahead) + 1)):
            ahead_by = forward[q] if q < len(forward) else 0
            if q > beyond:
                break
            back_by = min(backward[beyond - q], len(before)) if before else 0
            if back_by + ahead_by < q:
                continue
            if any(forward[q // p] >= q - q // p for p in _primes(q)):
                continue
            lo, hi = start + c - back_by, start + c + q + ahead_by
            held = waiting.get(q)
            if held and lo + q <= held[1]:
                waiting[q] = held[0], max(hi, held[1])
            else:
                if held:
                    yield q, *held
                waiting[q] = lo, hi
    for q, held in waiting.items():
        yield q, *held


def _searched(docs: DataFrame, id_type: str) -> DataFrame:
    """Of each text that needs tiles, a row with its words and a row per tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column(2)):
                chunk = Chunk(data, offsets)
                keys = batch.column(0).slice(first, end - first)
                ids = batch.column(1).slice(first, end - first)
                held, size, seen = [], 0, -1
                texts: set[int] = set()
                for tile in chunk.tiles():
                    held.append(tile)
                    texts.add(tile[0])
                    size += len(tile[-1])
                    if size > 1 << 18:
                        yield _tiles(held, keys, ids)
                        held, size = [], 0
                if held:
                    yield _tiles(held, keys, ids)
                for text in sorted(texts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([0], pa.int32()), keys.slice(text, 1), ids.slice(text, 1), pa.array([int(chunk.n[text])]),
                         pa.array([chunk.joined(text)]), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.list_(pa.int32()))], _NAMES)
    return docs.mapInArrow(run, FOUND.format(id=id_type))


_NAMES = ["kind", "key", "id", "n_words", "words", "scale", "start", "first", "last", "symbols"]


def _tiles(rows: list[tuple], keys: pa.Array, ids: pa.Array) -> pa.RecordBatch:
    text = pa.array([r[0] for r in rows])
    n = len(rows)
    ends = np.concatenate([[0], np.cumsum([len(r[-1]) for r in rows])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(n, np.int32)), keys.take(text), pa.nulls(n, ids.type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()),
         *[pa.array([r[i] for r in rows], pa.int64()) for i in range(1, 5)],
         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([r[-1] for r in rows])))], _NAMES)


def _plain(docs: DataFrame, id_type: str) -> DataFrame:
    """(id, n_words, collapsed) of the texts that need no tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in byte_chunks(batch.column(2)):
                chunk = Chunk(data, offsets)
                held = {tile[0] for tile in chunk.tiles()}
                rest = [t for t in range(end - first) if t not in held]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array([first + t for t in rest], pa.int64())), pa.array(chunk.n[rest]),
                     pa.array([chunk.joined(t) for t in rest], pa.string())], ["id", "n_words", "collapsed"])
    return docs.mapInArrow(run, f"id {id_type}, n_words long, collapsed string")


def _fragments(tiles: DataFrame) -> DataFrame:
    """(key, period, start, end) of the fragments of every tile, solved where the tile was dealt to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, scales, starts, firsts, lasts = (batch.column(i).to_pylist() for i in range(5))
            out = [(key, *f) for key, scale, start, first, last, symbols in zip(keys, scales, starts, firsts, lasts, batch.column(5))
                   for f in solve(symbols.as_py(), scale, start, first, last)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], ["key", "period", "start", "end"])
    return tiles.mapInArrow(run, "key long, period long, start long, end long")


def _stitched(fragments: DataFrame) -> DataFrame:
    """(key, start, length, period) of the runs: fragments of a text and period that overlap by a period are one."""
    order = Window.partitionBy("key", "period").orderBy("start", "end")
    upto = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") + F.col("period") <= upto, 0).otherwise(1)
    island = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = (fragments.withColumn("new", new).withColumn("island", island).groupBy("key", "period", "island")
            .agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length")))
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))).select("key", "start", "length", "period")


def _collapsed(rows: DataFrame, id_type: str) -> DataFrame:
    """(id, n_words, runs, collapsed) of (id, n_words, words, runs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, words, runs in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                drop = np.zeros(n + 1, np.int64)
                for r in runs.as_py() or []:
                    drop[r["start"] + r["period"]] += 1
                    drop[r["start"] + r["length"]] -= 1
                keep = np.cumsum(drop)[:n] == 0
                own = words.as_py()
                out.append(own if keep.all() else " ".join(w for w, k in zip(own.split(" "), keep) if k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(out, pa.string())], ["id", "n_words", "runs", "collapsed"])
    return rows.mapInArrow(run, f"id {id_type}, n_words long, runs {RUNS}, collapsed string")


RUNS = "array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_words, runs, collapsed.

    Words are what white space of ASCII parts; they are numbered from 0. A run
    is a longest stretch of words with a smallest period: words that far apart
    are equal, there are at least TIMES periods and LEAST words, and no word
    on either side goes on with it. ``runs`` has start, length and period of
    each, by start, then period. ``collapsed`` are the words joined by a
    blank, without those that some run holds after its first period.

    NULL and empty texts have no words, no runs and an empty collapsed text.
    Rows that repeat an id or a text stay rows of their own, NULL ids too. An
    empty table gives an empty one. Other columns are left out, whatever their
    names. Texts are worked on whole; a task holds one chunk of texts or the
    longest text. Texts with tiles are read once to make them, the others once
    more to join their words, so only the former are stored and shuffled.
    """
    id_type = dict(docs.dtypes)[id_col]
    docs = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    found, seen = stored(_searched(docs, id_type), dealt=F.sum(F.size("symbols")))
    tiles = found.where("kind = 1").select("key", "scale", "start", "first", "last", "symbols")
    # few bytes but much work: a stated number of partitions, which adaptive execution leaves as it is
    runs = _stitched(_fragments(tiles.repartition(int(seen["dealt"] or 0) // DEALT + 1, "key", "scale", "first")))
    lists = runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    # by start, then period: two runs of one start differ in period, and the longer one may have either
    ordered = F.array_sort("runs", lambda x, y: F.when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(
        F.signum(x["period"] - y["period"])).cast("int"))
    none = F.array().cast(RUNS)
    marked = found.where("kind = 0").join(lists, "key", "left").select(
        "id", "n_words", "words", F.coalesce(ordered, none).alias("runs"))
    plain = _plain(docs, id_type).select("id", "n_words", none.alias("runs"), "collapsed")
    result = _collapsed(marked, id_type).union(plain)
    return result.select(F.col("id").alias(id_col), "n_words", "runs", "collapsed")
