"""Benchmark decontamination: suffix arrays of the training texts, searched for every suffix of the test items.

Each task cuts its texts into shards of some megabytes and sorts the word
suffixes of a shard: by as many leading words as fit into 62 bits, then, where
these are equal, by prefix doubling until windows of ten words are told apart.
All windows of the test items, one per suffix, are looked up in that order by
binary search. The range found holds every place of the window, and places
that follow each other in text and item make up the longest verbatim matches.

The test items travel to the tasks in blocks of bounded size, so texts are
read once a block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from heatmart.llm.common import LOWER, byte_chunks, stored, word_array

WINDOW = 10
# Bytes of text whose suffixes are sorted together; a longer text is a shard of its own.
SHARD = 8 << 20
# Words of test items that are sent to the tasks at a time; about 30 bytes a word.
BLOCK = 4 << 20
# Words are digits, letters and everything beyond ASCII.
SPACE = np.ones(256, bool)
SPACE[0x30:0x3A] = SPACE[0x41:0x5B] = SPACE[0x61:0x7B] = SPACE[0x80:] = False

SPANS = "array<struct<start: long, length: long>>"
MATCHES = "array<struct<item: string, item_start: long, start: long, length: long>>"


class Block:
    """Windows of some test items: the words as numbers from 1, distinct windows, and where each occurs."""

    def __init__(self, ids: list[str | None], texts: pa.Array) -> None:
        self.ids = ids
        found, first = [], [np.zeros(1, np.int64)]
        for _, _, data, offsets in byte_chunks(texts):
            own, at = word_array(data, offsets, SPACE, LOWER)
            found.append(own)
            first.append(at[1:] + first[-1][-1])
        coded = pa.chunked_array(found or [pa.array([], pa.large_binary())]).combine_chunks().dictionary_encode()
        self.words = coded.dictionary
        number = coded.indices.to_numpy() + 1
        first = np.concatenate(first)
        n = np.diff(first)
        # zeros after each item, so that a short item's window ends in them
        at = np.arange(len(number)) + np.repeat(np.arange(len(n)) * WINDOW, n)
        self.symbols = np.zeros(len(number) + len(n) * WINDOW + WINDOW, np.int32)
        self.symbols[at] = number
        count = np.where(n > 0, np.maximum(n - WINDOW + 1, 1), 0)
        item = np.repeat(np.arange(len(n)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = (first[:-1] + np.arange(len(n)) * WINDOW)[item] + place
        every = self.symbols[start[:, None] + np.arange(WINDOW)]
        _, one, kind = np.unique(every, axis=0, return_index=True, return_inverse=True)
        self.start = start[one]
        order = np.argsort(kind.ravel(), kind="stable")
        self.item, self.place = item[order], place[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(kind.ravel(), minlength=len(one)))]).astype(np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """A row of word numbers per distinct window, and its number of words."""
        rows = self.symbols[self.start[:, None] + np.arange(WINDOW)]
        return rows, (rows > 0).sum(axis=1)


def suffix_array(symbols: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of all suffixes that start with a test word, sorted by WINDOW symbols; their first symbols packed, and how many.

    Symbols are numbers below 2 ** bits; 0, any other word or the end of a
    text, comes first. The array must end in 2 * WINDOW zeros.
    """
    packed = min(62 // bits, WINDOW)
    n = len(symbols) - 2 * WINDOW
    key = symbols[:n].astype(np.int64)
    for j in range(1, packed):
        key <<= bits
        key |= symbols[j:n + j]
    order = np.flatnonzero(symbols[:n])
    key = key[order]
    by = np.argsort(key)
    order, key = order[by], key[by]
    depth, sorted_by = packed, key
    while depth < WINDOW and len(order):
        new = np.concatenate([[True], sorted_by[1:] != sorted_by[:-1]])
        rank = np.cumsum(new)
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            break
        at = np.zeros(len(symbols), np.int64)
        at[order] = rank
        sorted_by = rank * (len(order) + 1)
        own = sorted_by[tied] + at[order[tied] + depth]
        by = np.argsort(own)
        order[tied], sorted_by[tied] = order[tied][by], own[by]
        depth *= 2
    return order, key, packed


def search(symbols: np.ndarray, rows: np.ndarray, size: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and place of each window in symbols, by binary search of every window in their suffix array."""
    order, key, packed = suffix_array(symbols, bits)
    low = np.zeros(len(rows), np.int64)
    high = np.zeros(len(rows), np.int64)
    for j in range(packed):
        low = (low << bits) | rows[:, j]
        high = (high << bits) | np.where(j < size, rows[:, j], (1 << bits) - 1)
    lo, hi = np.searchsorted(key, low, "left"), np.searchsorted(key, high, "right")
    live = np.flatnonzero(lo < hi)
    lo, hi, asked, size = lo[live], hi[live], rows[live], size[live]
    columns = np.arange(packed, WINDOW)

    def bound(after: bool) -> np.ndarray:
        a, b = lo.copy(), hi.copy()
        while len(open_ := np.flatnonzero(a < b)):
            middle = (a[open_] + b[open_]) // 2
            there = symbols[order[middle][:, None] + columns] - asked[open_][:, packed:]
            there[columns >= size[open_, None]] = 0
            differs = there != 0
            which = differs.argmax(axis=1)
            sign = np.where(differs.any(axis=1), np.sign(there[np.arange(len(open_)), which]), 0)
            right = (sign < 0) | (after & (sign == 0))
            a[open_] = np.where(right, middle + 1, a[open_])
            b[open_] = np.where(right, b[open_], middle)
        return a

    if packed < WINDOW and len(live):
        lo, hi = bound(False), bound(True)
    count = hi - lo
    at = np.arange(count.sum()) + np.repeat(lo - np.cumsum(count) + count, count)
    return np.repeat(live, count), order[at]


class Searcher:
    """Looks a block's windows up in runs of texts."""

    def __init__(self, block: Block) -> None:
        self.block = block
        self.rows, self.size = block.windows()
        self.bits = max(int(len(block.words)).bit_length(), 1)

    def found(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; and of each hit its text, its place there, its window."""
        words, first = word_array(data, offsets, SPACE, LOWER)
        n = np.diff(first)
        own = pc.index_in(words, value_set=self.block.words)
        number = pc.fill_null(own, -1).to_numpy() + 1
        texts = np.repeat(np.arange(len(n)), n)
        symbols = np.zeros(len(number) + len(n) + 2 * WINDOW, np.int32)
        symbols[np.arange(len(number)) + texts] = number
        window, place = search(symbols, self.rows, self.size, self.bits)
        begin = first[:-1] + np.arange(len(n))
        text = np.searchsorted(begin, place, "right") - 1
        return n, text, place - begin[text], window

    def spans(self, n: int, text: np.ndarray, place: np.ndarray, window: np.ndarray) -> pa.Array:
        """Maximal stretches of words within windows, a list per text."""
        order = np.lexsort((place, text))
        text, start = text[order], place[order]
        end = start + self.size[window[order]]
        # ends grow along the texts if each text's are lifted above the one's before
        lift = text * (int(end.max(initial=0)) + 1)
        upto = np.maximum.accumulate(end + lift) if len(end) else end
        new = np.flatnonzero(np.concatenate([[True], (start + lift)[1:] > upto[:-1]])) if len(end) else np.zeros(0, np.int64)
        last = np.append(new[1:], len(end))[:len(new)] - 1
        starts = start[new]
        return _lists(n, text[new], pa.StructArray.from_arrays(
            [pa.array(starts), pa.array((upto - lift)[last] - starts if len(new) else starts)], ["start", "length"]))

    def matches(self, n: int, text: np.ndarray, place: np.ndarray, window: np.ndarray) -> pa.Array:
        """The longest match of each text with each item, the first of equal ones, a list per text."""
        block = self.block
        count = block.first[window + 1] - block.first[window]
        at = np.arange(count.sum()) + np.repeat(block.first[window] - np.cumsum(count) + count, count)
        text, place, length = (np.repeat(x, count) for x in (text, place, self.size[window]))
        item, there = block.item[at], block.place[at]
        order = np.lexsort((place, place - there, item, text))
        text, place, length, item, there = (x[order] for x in (text, place, length, item, there))
        new = np.ones(len(text), bool)
        new[1:] = ((text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1)
                   | (there[1:] != there[:-1] + 1))
        new = np.flatnonzero(new)
        text, place, item, there = text[new], place[new], item[new], there[new]
        length = length[new] + np.diff(np.append(new, len(length))) - 1
        order = np.lexsort((there, place, -length, item, text))
        text, place, item, there, length = (x[order] for x in (text, place, item, there, length))
        best = np.ones(len(text), bool)
        best[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
        best = np.flatnonzero(best)
        names = pa.array(block.ids, pa.string()).take(pa.array(item[best]))
        return _lists(n, text[best], pa.StructArray.from_arrays(
            [names, pa.array(there[best]), pa.array(place[best]), pa.array(length[best])],
            ["item", "item_start", "start", "length"]))


def _lists(n: int, owner: np.ndarray, values: pa.Array) -> pa.Array:
    ends = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator:
    """The test items, a broadcast block of about BLOCK words after the other.

    Words are counted as half the bytes, which no text exceeds by more than
    one. A block holds whole items, so a longer item makes a larger block.
    """
    spark = benchmark.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    items, seen = stored(benchmark.select(F.col(id_col).cast("string").alias("id"), text.alias("text")),
                         words=F.sum(F.octet_length(text) / 2 + 1))
    count = int((seen["words"] or 0) // BLOCK) + 1
    block = F.pmod(F.xxhash64("text", "id"), F.lit(count))
    for b in range(count):
        rows = items.where(block == b).toArrow()
        made = Block(rows.column("id").to_pylist(), rows.column("text").combine_chunks())
        if len(made.words) or not b:
            yield spark.sparkContext.broadcast(made)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of docs: id, n_words, n_hit, spans, matches, contaminated.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in
    lower case. A window is ten words in a row of an item; an item with fewer
    is one window. ``spans`` are the maximal stretches of words within found
    windows, n_hit their words; ``matches`` has, for each item with a found
    window, its longest verbatim match: item as a string, first word in the
    item, first word in the text, words. Items that share an id, or have none,
    are items of their own.

    NULL and empty texts have no words and no hits; without test items no
    text has any. Rows that repeat an id or a text stay rows of their own.
    Other columns are left out, whatever their names. Long texts and items are
    searched whole. Memory of a task: a shard's or the longest text's words,
    and the block of test items.
    """
    kind = dict(docs.dtypes)[id_col]
    blocks = list(_blocks(benchmark, item_col, item_text))
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    if len(blocks) > 1:
        rows, _ = stored(rows)

    def searched(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value)
            for batch in batches:
                for first, end, data, offsets in byte_chunks(batch.column(2), SHARD):
                    n, *hits = searcher.found(data, offsets)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first), pa.array(n),
                         searcher.spans(len(n), *hits), searcher.matches(len(n), *hits)],
                        ["key", "id", "n_words", "spans", "matches"])
        return rows.mapInArrow(run, f"key long, id {kind}, n_words long, spans {SPANS}, matches {MATCHES}")

    found = searched(blocks[0])
    if len(blocks) > 1:
        for shared in blocks[1:]:
            found = found.union(searched(shared).where("size(spans) > 0"))
        found = found.groupBy("key").agg(
            F.any_value("id", ignoreNulls=True).alias("id"), F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("matches")).alias("matches"))
    spans = _united(F.col("spans"))
    return found.select(
        F.col("id").alias(id_col), "n_words", spans.alias("spans"), F.array_sort("matches").alias("matches")).select(
        id_col, "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"]).alias("n_hit"),
        "spans", "matches", (F.size("spans") > 0).alias("contaminated"))


def _united(spans: Column) -> Column:
    """Overlapping and touching spans as one."""
    def joined(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        end = F.greatest(last["start"] + last["length"], s["start"] + s["length"])
        grown = F.struct(last["start"].alias("start"), (end - last["start"]).alias("length"))
        before = F.slice(done, 1, F.size(done) - 1)
        apart = (F.size(done) == 0) | (s["start"] > last["start"] + last["length"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(F.concat(before, F.array(grown)))
    return F.when(F.size(spans) > 1, F.aggregate(F.array_sort(spans), F.array().cast(SPANS), joined)).otherwise(spans)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, in whose text no window of a test item occurs.

    NULL texts stay. The rest is as for contamination().
    """
    for shared in _blocks(benchmark, item_col, item_text):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value)
            for batch in batches:
                column = batch.column(batch.schema.get_field_index(text_col)).cast(pa.string())
                for first, end, data, offsets in byte_chunks(column, SHARD):
                    _, text, *_ = searcher.found(data, offsets)
                    clean = np.ones(end - first, bool)
                    clean[text] = False
                    yield batch.slice(first, end - first).filter(pa.array(clean))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
