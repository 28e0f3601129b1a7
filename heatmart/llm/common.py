"""What the operators share: stored tables, byte views of Arrow columns, word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

U64 = np.uint64
# Bytes of text that a task turns into arrays at a time.
CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local master without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="heatmart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, **figures: Column) -> tuple[DataFrame, dict]:
    """Write df once to the shared folder; the table read back, and aggregates seen on the way.

    Cuts lineage: a lost executor costs a re-read. ``path`` names the folder for drop().
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                         *[c.alias(n) for n, c in figures.items()])
    watched.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), {**seen.get, "path": path}


def drop(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def byte_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of about ``limit`` bytes.

    Yields (first row, end row, bytes, offsets); NULL counts as empty. A longer
    text makes a run of its own, whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, on a copy."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def noise(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


class Rolling:
    """Hashes of byte ranges by one running sum of letter value times a power."""

    BASE = 0x9E3779B97F4A7C55

    def __init__(self, seed: int) -> None:
        self.letters = noise(256, seed)
        self.up = self.down = np.zeros(0, U64)

    def sums(self, data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        n = len(data) + 1
        if len(self.up) < n:
            def powers(b: int) -> np.ndarray:
                p = np.full(n, U64(b % 2 ** 64))
                p[0] = 1
                return np.cumprod(p)
            self.up, self.down = powers(self.BASE), powers(pow(self.BASE, -1, 2 ** 64))
        letters = self.letters if fold is None else self.letters[fold]
        total = np.zeros(n, U64)
        value = np.take(letters, data)
        value *= self.up[:n - 1]
        np.cumsum(value, out=total[1:])
        return total

    def ranges(self, total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for each pair, mixed with the length."""
        h = (total[end] - total[start]) * self.down[start]
        return mix(h + (end - start).astype(U64) * U64(0xD1B54A32D192ED03))

    def windows(self, total: np.ndarray, length: int) -> np.ndarray:
        """ranges() of all ranges of one length, in order."""
        h = (total[length:] - total[:-length]) * self.down[:len(total) - length]
        return mix(h + U64(length * 0xD1B54A32D192ED03 % 2 ** 64))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of other bytes than white space, and each text's first word.

    The third array has one entry more than there are texts. ``space`` names the bytes between words.
    """
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = np.take(space, data)
    inside = ~gap
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    start = inside[1:-1] & gap[:-2]
    end = inside[1:-1] & gap[2:]
    if len(edge):
        start[edge] |= inside[1:-1][edge]
        end[edge - 1] |= inside[1:-1][edge - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_array(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE,
               fold: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """The words themselves as an Arrow array, ``fold`` applied to each byte, and each text's first word."""
    starts, ends, first = words(data, offsets, space)
    inside = data[~space[data]]
    ends = np.concatenate([[0], np.cumsum(ends - starts)])
    inside = inside if fold is None else fold[inside]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(inside)]), first


WORDS = Rolling(11)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word with A-Z in lower case, and each text's first word."""
    starts, ends, first = words(data, offsets)
    total = WORDS.sums(data, LOWER)
    return WORDS.ranges(total, starts, ends), first


def mixed_word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As word_hashes(), for comparing sets by hash alone: every eight letters are mixed by themselves.

    Sums of letters times powers, as in Rolling, agree for some long words made
    of few letters; mixed blocks leave no such families.
    """
    starts, ends, first = words(data, offsets)
    if not len(starts):
        return np.zeros(0, U64), first
    n = ends - starts
    blocks = (n + 7) >> 3
    begin = np.cumsum(blocks) - blocks
    within = np.arange(int(blocks.sum())) - np.repeat(begin, blocks)
    at = np.repeat(starts, blocks) + 8 * within
    text = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
    # the eight bytes from each position on, without those behind the word
    eights = np.ndarray((len(data) + 1,), "<u8", text, strides=(1,))[at]
    spare = np.maximum(8 - (np.repeat(ends, blocks) - at), 0).astype(U64) * U64(8)
    h = mix(eights & (U64(2 ** 64 - 1) >> spare))
    h = mix(h + (within + 1).astype(U64) * U64(0x9E3779B97F4A7C15))
    return mix(np.add.reduceat(h, begin) + n.astype(U64) * U64(0xD1B54A32D192ED03)), first


SHINGLE = noise(8, 23) | U64(1)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, text by text, and each text's first one.

    A text with fewer words has the whole sequence as its only one, a text
    without words has none.
    """
    h, first = mixed_word_hashes(data, offsets)
    n = np.diff(first)
    padded = np.concatenate([h, np.zeros(size, U64)])
    total = np.zeros(len(h), U64)
    for i in range(size):
        total += padded[i:i + len(h)] * SHINGLE[i]
    keep = np.maximum(n - size + 1, (n > 0).astype(n.dtype))
    out_first = np.concatenate([[0], np.cumsum(keep)])
    at = np.repeat(first[:-1] - out_first[:-1], keep) + np.arange(out_first[-1])
    out = total[at]
    for t in np.flatnonzero((n > 0) & (n < size)):
        own = h[first[t]:first[t + 1]]
        out[out_first[t]] = np.append(own * SHINGLE[:len(own)], noise(1, len(own))).sum(dtype=U64)
    return mix(out), out_first
