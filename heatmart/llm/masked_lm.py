"""Masked pseudo-likelihood: a small network predicts every word from the words on both sides."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from heatmart.llm.common import U64, byte_chunks, noise, stored, word_hashes

# The network predicts CLASSES * MEMBERS buckets of words; classes gather buckets of like frequency.
# Within its bucket, a word has the probability of its count in the corpus.
CLASSES, MEMBERS = 32, 64
BUCKETS = CLASSES * MEMBERS  # a power of two
SIDE = 2  # words seen on each side
WIDTH, HIDDEN = 12, 32
# Rounds of training and averaging. One round looks at one position in STRIDE,
# the next at their right neighbours: together they look at every position.
STRIDE = 2
ROUNDS = 2
BATCH = 1024
RATE = 0.004
# Words that a task counts, and positions that it scores, at a time.
TOGETHER, BLOCK = 1 << 22, 8192
# Fewer than so many words, the most frequent ones, are sent to the tasks that
# score. The counts of all others are joined by Spark.
FREQUENT = 65536
# What every word, and all unseen words of a bucket together, count besides their occurrences.
UNSEEN = 0.5
# Counts in a shuffle partition up to which they are joined by a hash table, without sorting.
IN_TABLE = 1 << 21

# The last row of cls and of each class in mem are the biases: the hidden layer ends with a one.
SHAPES = {"emb": (BUCKETS + 1, WIDTH), "inner": (2 * SIDE * WIDTH, HIDDEN), "inner_b": (HIDDEN,),
          "cls": (HIDDEN + 1, CLASSES), "mem": (CLASSES, HIDDEN + 1, MEMBERS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
# 2 ** x from -0.5 to 0.5, as powers of x, within 3e-6 of its value.
POWER = np.array([0.999999261, 0.693121815, 0.240247448, 0.0559178603, 0.00957010143], np.float32)
# Where each weight of the embeddings stands.
PLACES = np.arange((BUCKETS + 1) * WIDTH).reshape(-1, WIDTH)


def exponentials(x: np.ndarray) -> np.ndarray:
    """exp() of 32-bit numbers, in place, within 1e-5 of its value; numbers beyond -87 and 87 count as those.

    As 2 ** (whole + rest): a polynomial of the rest, with the whole number added
    to its exponent. numpy's own works number by number on some processors.
    """
    np.clip(x, -87, 87, out=x)
    x *= np.float32(1 / np.log(2))
    shift = np.float32(1.5 * 2 ** 23)
    whole = x + shift  # rounded: the last bits are those of the whole number
    out = whole - shift
    x -= out
    np.multiply(x, POWER[4], out=out)
    for c in POWER[3:0:-1]:
        out += c
        out *= x
    np.add(out, POWER[0], out=x)
    bits, exponent = x.view(np.int32), whole.view(np.int32)
    exponent <<= 23
    bits += exponent
    return x


class Net:
    """Embeddings of 2 * SIDE neighbours, one hidden layer, class and member by two softmaxes."""

    def __init__(self, flat: np.ndarray) -> None:
        self.flat = flat
        at = 0
        for name, shape in SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, flat[at:at + n].reshape(shape))
            at += n
        self.cls_b, self.mem_b = self.cls[HIDDEN], self.mem[:, HIDDEN]
        self.slope: Net | None = None

    @classmethod
    def start(cls, counts: np.ndarray) -> "Net":
        """Small fixed random weights; output biases from the corpus counts, most frequent bucket first."""
        net = cls(np.empty(SIZE, np.float32))
        small, at = (((noise(SIZE, 97) >> U64(40)).astype(np.float32) / 2 ** 24) - 0.5) * np.float32(0.2), 0
        for part in (net.emb, net.inner, net.inner_b, net.cls[:HIDDEN], net.cls_b, net.mem[:, :HIDDEN], net.mem_b):
            part[:] = small[at:at + part.size].reshape(part.shape)
            at += part.size
        p = np.log(counts + 1.0)
        by_class = np.log((counts + 1.0).reshape(CLASSES, MEMBERS).sum(1))
        net.cls_b[:] = by_class - by_class.mean()
        net.mem_b[:] = p.reshape(CLASSES, MEMBERS) - by_class[:, None]
        return net

    def hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Embeddings of the neighbours, the hidden layer, and the same with a one at its end."""
        x = np.take(self.emb, context, axis=0).reshape(len(context), -1)
        inner = np.dot(x, self.inner)
        inner += self.inner_b
        h = np.empty((len(x), HIDDEN + 1), np.float32)
        h[:, :HIDDEN], h[:, HIDDEN] = np.tanh(inner, out=inner), 1
        return x, inner, h

    @staticmethod
    def by_class(word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
        """An order by class; in it, class and member of each word, and the rows of each class there is."""
        word = word.astype(np.uint16)
        c = (word // MEMBERS).astype(np.uint8)
        order = np.argsort(c, kind="stable")
        edge = [0, *np.cumsum(np.bincount(c, minlength=CLASSES)).tolist()]
        return order, c[order], word[order] % MEMBERS, [(k, slice(*edge[k:k + 2])) for k in range(CLASSES) if edge[k] < edge[k + 1]]

    def class_logits(self, h: np.ndarray, spans: list[tuple[int, slice]]) -> np.ndarray:
        return np.dot(h, self.cls)

    def member_logits(self, h: np.ndarray, spans: list[tuple[int, slice]]) -> np.ndarray:
        out = np.empty((len(h), MEMBERS), np.float32)
        for k, rows in spans:
            np.dot(h[rows], self.mem[k], out=out[rows])
        return out

    @staticmethod
    def softmax(logits: Callable, h: np.ndarray, spans: list[tuple[int, slice]],
                own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Exponentials, their sums, and the own column's logits; all less each row's maximum where sums would not fit."""
        for shift in (False, True):
            e = logits(h, spans)
            if shift:
                e -= e.max(1, keepdims=True)
            mine = None if own is None else e[np.arange(len(own)), own]
            norm = np.dot(exponentials(e), np.ones(e.shape[1], np.float32))
            if not len(norm) or (norm.min() > 1e-30 and norm.max() < 1e30):
                break
        return e, norm, mine

    def log_prob(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        order, c, m, spans = self.by_class(word)
        *_, h = self.hidden(context[order])
        out = np.empty(len(word), np.float32)
        _, norm, mine = self.softmax(self.class_logits, h, spans, c)
        _, norm_m, mine_m = self.softmax(self.member_logits, h, spans, m)
        out[order] = mine - np.log(norm) + mine_m - np.log(norm_m)
        return out

    def gradient(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of the mean negative log-probability, in the layout of the weights; the next call writes over it.

        Positions are put in order of their class first, so that each class is a run of rows.
        """
        def slopes(logits: Callable, own: np.ndarray) -> np.ndarray:
            e, norm, _ = self.softmax(logits, h, spans)
            e *= (each / norm)[:, None]
            e.reshape(-1)[np.arange(0, e.size, e.shape[1]) + own] -= each
            return e

        g = self.slope = self.slope or Net(np.empty(SIZE, np.float32))
        order, c, m, spans = self.by_class(word)
        context = context[order]
        x, inner, h = self.hidden(context)
        each, one = np.float32(1 / len(word)), np.ones(len(word), np.float32)
        p = slopes(self.class_logits, c)
        np.dot(h.T, p, out=g.cls)
        back = np.dot(p, self.cls[:HIDDEN].T)
        p = slopes(self.member_logits, m)
        through = np.empty_like(back)
        if len(spans) < CLASSES:
            g.mem[:] = 0
        for k, run in spans:
            np.dot(h[run].T, p[run], out=g.mem[k])
            np.dot(p[run], self.mem[k, :HIDDEN].T, out=through[run])
        back += through
        inner *= inner
        back *= np.subtract(1, inner, out=inner)
        np.dot(x.T, back, out=g.inner)
        np.dot(one, back, out=g.inner_b)
        g.emb[:] = 0
        np.add.at(g.emb.reshape(-1), np.take(PLACES, context, axis=0).ravel(), np.dot(back, self.inner.T).ravel())
        return g.flat


class Adam:
    """Steps of moving averages of the gradient and of its square; both are kept without their factors."""

    def __init__(self) -> None:
        self.first, self.second, self.step, self.steps = (*np.zeros((2, SIZE), np.float32), np.empty(SIZE, np.float32), 0)

    def move(self, flat: np.ndarray, g: np.ndarray) -> None:
        first, second, step = self.first, self.second, self.step
        self.steps += 1
        root = np.sqrt(0.01 / (1 - 0.99 ** self.steps))
        first *= np.float32(0.9)
        first += g
        second *= np.float32(0.99)
        second += np.multiply(g, g, out=step)
        np.sqrt(second, out=step)
        step += np.float32(1e-8 / root)
        np.divide(first, step, out=step)
        step *= np.float32(RATE * 0.1 / (1 - 0.9 ** self.steps) / root)
        flat -= step


@dataclass
class Vocabulary:
    """Rank of each hash bucket, counts of all words, and what scoring needs of them.

    ``table`` has (word, n) of every word, by its 64-bit hash; ``common`` and
    ``times`` hold those of the frequent ones, which occur at least ``least``
    times, by rising hash, ``total`` the sum of each bucket, by rank, with
    UNSEEN for each of its words and once for those it has not seen.
    """

    rank: np.ndarray
    table: DataFrame
    common: np.ndarray
    times: np.ndarray
    total: np.ndarray
    least: float
    rare: int


def _hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of texts: rows, hashes of all words, each text's first word."""
    for first, end, data, offsets in byte_chunks(column):
        h, at = word_hashes(data, offsets)
        yield first, end, h, at


def _tokens(column: pa.Array, rank: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of texts: rows, buckets of all words by rank, each text's first word."""
    for first, end, h, at in _hashes(column):
        yield first, end, rank[(h % U64(BUCKETS)).astype(np.int64)], at


def _spaced(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with SIDE times the bucket BUCKETS around each text, and where each word stands there."""
    where = np.arange(len(words)) + SIDE * np.repeat(np.arange(1, len(at)), np.diff(at))
    out = np.full(len(words) + SIDE * len(at), BUCKETS, np.int64)
    out[where] = words
    return out, where


AROUND = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])


def _contexts(words: np.ndarray, at: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The SIDE words before and after each place; beyond a text's ends the bucket BUCKETS."""
    spaced, where = _spaced(words, at)
    return spaced[where[places][:, None] + AROUND]


class Lookup:
    """Finds 64-bit hashes in a rising array of them: by their first bits, then by steps to the right."""

    def __init__(self, known: np.ndarray) -> None:
        bits = max((16 * len(known)).bit_length(), 4)
        self.known, self.shift = np.append(known, U64(0)), U64(64 - bits)
        self.edge = np.searchsorted(known >> self.shift, np.arange((1 << bits) + 1, dtype=U64))
        self.widest = int(np.diff(self.edge).max())

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash stands, and whether it does."""
        slot = (h >> self.shift).astype(np.int64)
        place, end = self.edge[slot], self.edge[slot + 1]
        found = (self.known[place] == h) & (place < end)
        for _ in range(1, self.widest):
            on = np.flatnonzero(~found & (place + 1 < end))
            place[on] += 1
            found[on] = self.known[place[on]] == h[on]
        return place, found


HASHED = "buckets binary, first binary, word array<long>, n array<long>"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the buckets of a chunk's words and each text's first word, and rows with different words and their numbers.

    The latter are of TOGETHER words or so, whichever texts have them.
    """
    def row(**values: np.ndarray | bytes) -> pa.RecordBatch:
        kinds = {"buckets": pa.binary(), "first": pa.binary(), "word": pa.list_(pa.int64()), "n": pa.list_(pa.int64())}
        return pa.RecordBatch.from_arrays([pa.array([values.get(c)], kind) for c, kind in kinds.items()], list(kinds))

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        word, n = np.unique(np.concatenate(held), return_counts=True)
        for i in range(0, len(word), 1 << 14):
            yield row(word=word[i:i + (1 << 14)].view(np.int64), n=n[i:i + (1 << 14)])

    held, many = [], 0
    for batch in batches:
        for _, _, h, at in _hashes(batch.column(0)):
            yield row(buckets=(h % U64(BUCKETS)).astype(np.uint16).tobytes(), first=at.astype(np.int64).tobytes())
            held.append(h)
            many += len(h)
            if many >= TOGETHER:
                yield from counted(held)
                held, many = [], 0
    if many:
        yield from counted(held)


def _chunks(batch: pa.RecordBatch, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets by rank and each text's first word, of the chunks of texts or of _hashed() rows."""
    if not pa.types.is_binary(batch.column(0).type):
        for _, _, words, at in _tokens(batch.column(0), rank):
            yield words, at
        return
    for buckets, first in zip(batch.column(0), batch.column(1)):
        yield rank[np.frombuffer(buckets.as_buffer(), np.uint16)], np.frombuffer(first.as_buffer(), np.int64)


def vocabulary(hashed: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The words of a table of _hashed() rows, and the number of words of each bucket by rank."""
    pairs = hashed.where("word is not null").select(F.inline(F.arrays_zip("word", "n")))
    table, _ = stored(pairs.groupBy("word").agg(F.sum("n").alias("n")))
    counts, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in table.groupBy(F.col("word").bitwiseAND(BUCKETS - 1).alias("bucket")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        counts[r["bucket"]], kinds[r["bucket"]] = r["n"], r["words"]
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(BUCKETS, np.int64)
    rank[order] = np.arange(BUCKETS)
    # Numbers of words by size, in sixteenths of a doubling: at most 1,024 rows.
    sizes = table.groupBy(F.floor(16 * F.log2("n")).alias("size")).agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    least, many = float("inf"), 0
    for r in sorted(sizes, key=lambda r: -r["size"]):
        many += r["words"]
        if many >= FREQUENT:
            break
        least = float(r["n"])
    often = table.where(F.col("n") >= least).select("word", "n").toArrow()
    word, n = (often.column(c).to_numpy() for c in ("word", "n"))
    word = word.view(U64)
    rising = np.argsort(word)
    total = (counts + UNSEEN * (kinds + 1))[order]
    return Vocabulary(rank, table, word[rising], n[rising], total, least, int(kinds.sum()) - len(word)), counts[order]


def _mixed(n: int, seed: int) -> np.ndarray:
    """A fixed pseudo-random order of n: that of their noise, whose last bits give way to the number itself."""
    bits = U64(n.bit_length())
    key = noise(n, seed) >> bits << bits | np.arange(n, dtype=U64)
    key.sort()
    return (key & ((U64(1) << bits) - U64(1))).astype(np.int64)


def _trained(flat: np.ndarray, rank: np.ndarray, turn: int, rounds: int = ROUNDS):
    """Train on this turn's share of the positions of a partition's texts; the resulting weights and the number of positions."""
    stride = max(min(STRIDE, rounds), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, adam, seen = Net(flat.copy()), Adam(), 0
        for batch in batches:
            for words, at in _chunks(batch, rank):
                places = np.arange(turn % stride, len(words), stride)
                places = places[_mixed(len(places), turn)]
                spaced, where = _spaced(words, at)
                where, target = where[places], words[places]
                for i in range(0, len(places), BATCH):
                    context = spaced[where[i:i + BATCH, None] + AROUND]
                    adam.move(net.flat, net.gradient(context, target[i:i + BATCH]))
                seen += len(places)
        if seen:
            for i in range(0, SIZE, 4096):
                part = net.flat[i:i + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(i, i + len(part))), pa.array(part.astype(np.float64) * seen), pa.array(np.full(len(part), seen))],
                    ["at", "value", "n"])
    return run


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> tuple[np.ndarray, Vocabulary]:
    """Weights and vocabulary, from all texts.

    Every different word is counted, in a stored table that grows with the
    corpus; the rounds together train on every word: fewer rounds than STRIDE
    look at more positions each. In each round, every partition trains on its
    share from the common weights; the results are averaged by Spark, weighted
    by positions, one row per weight. The driver receives BUCKETS sums, fewer
    than FREQUENT words and SIZE weights, whatever the data. Results depend on
    how the table is split into partitions. No words at all leave the start
    weights.
    """
    texts = docs.select(F.col(text_col).cast("string"))
    # Each word is hashed once for the counts and all rounds; kept split as the table is.
    hashed = texts.mapInArrow(_hashed, HASHED).persist(StorageLevel.DISK_ONLY)
    words, counts = vocabulary(hashed)
    chunks = hashed.where("buckets is not null").select("buckets", "first")
    rank, flat = words.rank, Net.start(counts).flat
    for turn in range(rounds):
        got = (chunks.mapInArrow(_trained(flat, rank, turn, rounds), "at long, value double, n long").groupBy("at")
               .agg((F.sum("value") / F.sum("n")).alias("value")).toArrow())
        if got.num_rows:
            flat = flat.copy()
            flat[got.column("at").to_numpy()] = got.column("value").to_numpy().astype(np.float32)
    hashed.unpersist()
    return flat, words


def scored(spark: SparkSession, docs: DataFrame, flat: np.ndarray, words: Vocabulary, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, log_prob (sum over all words), mean_log_prob.

    Every word of the whole text is predicted from its neighbours: its bucket
    by the network, the word within the bucket by (n + UNSEEN) of its count n
    over the bucket's total, where n is 0 for a word the corpus has not. The
    counts of frequent words go to the tasks, other words are joined with
    theirs by Spark. NULL and empty texts have no words, a sum of 0 and no mean.
    """
    model = spark.sparkContext.broadcast((flat, words.rank, words.common, words.times, words.total))
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = source.dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, rank, common, times, total = model.value
        net, often = Net(weights), Lookup(common)
        share, bucket = np.append(np.log(times + UNSEEN), 0.0), np.log(total)
        for batch in batches:
            for first, end, h, at in _hashes(batch.column(1)):
                own = rank[(h % U64(BUCKETS)).astype(np.int64)]
                spaced, where = _spaced(own, at)
                p = np.empty(len(own))
                for i in range(0, len(own), BLOCK):
                    p[i:i + BLOCK] = net.log_prob(spaced[where[i:i + BLOCK, None] + AROUND], own[i:i + BLOCK])
                p -= bucket[own]
                place, found = often.find(h)
                p[found] += share[place[found]]
                n = np.diff(at)
                sums = np.diff(np.concatenate([[0.0], np.cumsum(p)])[at])
                # The other words of each text, to be joined with their counts.
                left = np.concatenate([[0], np.cumsum(~found)])[at]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(n), pa.array(sums),
                     pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), pa.array(h[~found].view(np.int64)))],
                    [id_col, "n_words", "__sum", "__rare"])

    each = source.mapInArrow(run, f"`{id_col}` {kind}, n_words long, __sum double, __rare array<long>")
    each, _ = stored(each.withColumn("__row", F.monotonically_increasing_id()))
    rare = each.select("__row", F.explode("__rare").alias("word"))
    counts = words.table.where(F.col("n") < words.least).select("word", F.log(F.col("n") + F.lit(UNSEEN)).alias("share"))
    if words.rare <= IN_TABLE * int(spark.conf.get("spark.sql.shuffle.partitions")):
        counts = counts.hint("shuffle_hash")
    share = F.coalesce("share", F.log(F.lit(UNSEEN)))
    rest = rare.join(counts, "word", "left").groupBy("__row").agg(F.sum(share).alias("__rest"))
    total = F.col("__sum") + F.coalesce("__rest", F.lit(0.0))
    return each.drop("__rare").join(rest, "__row", "left").select(id_col, "n_words", total.alias("log_prob")).withColumn(
        "mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))
