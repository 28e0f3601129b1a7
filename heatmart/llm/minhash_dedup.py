"""Near-duplicate texts: an inverted join over MinHash coordinates, confirmed on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heatmart.llm.common import U64, byte_chunks, noise, shingle_hashes, stored
from heatmart.llm.components import components

# Coordinates of a signature, and the probability with which two sets of just
# the asked similarity may agree on fewer of them than matches() says. Pairs
# that agree on fewer meet all the same and are compared on full sets, except
# with probability UNSEEN.
COORDINATES = 48
LOSS = 4e-5
UNSEEN = 1e-12
# Set sizes within this factor form a class.
CLASS = 1.03

_XOR, _TIMES = noise(COORDINATES, 41), noise(COORDINATES, 43) | U64(1)
_TAG = np.arange(COORDINATES, dtype=U64)


def matches(percent: float, loss: float = LOSS) -> int:
    """Coordinates that sets of this similarity have in common, except with probability ``loss``.

    30 of 48 for 85 (3.1e-5 have fewer), 26 for 80 (1.3e-5); with UNSEEN 20 and 16.
    """
    p, fewer = min(percent / 100, 1.0), 0.0
    for m in range(COORDINATES):
        fewer += math.comb(COORDINATES, m) * p ** m * (1 - p) ** (COORDINATES - m)
        if fewer > loss:
            if not m:
                raise ValueError(f"{COORDINATES} coordinates are too few for {percent} percent")
            return m
    return COORDINATES


def _signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each coordinate, the coordinate's number in the low six bits."""
    least = np.full(COORDINATES, U64(2 ** 64 - 1))
    for i in range(0, len(shingles), 4096):
        part = (shingles[None, i:i + 4096] ^ _XOR[:, None]) * _TIMES[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return ((least & ~U64(63)) | _TAG).view(np.int64)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = 5) -> DataFrame:
    """(id, n_shingles, k1, k2, sig) per row; k1, k2 name the shingle set.

    NULL and wordless texts have no shingles, NULL keys and an empty signature.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in byte_chunks(batch.column(1)):
                h, at = shingle_hashes(data, offsets, words)
                n, k1, k2, sig = [], [], [], []
                for a, b in zip(at[:-1], at[1:]):
                    own = np.unique(h[a:b])
                    n.append(len(own))
                    if len(own):
                        k1.append(int((own * (own >> U64(7) | U64(1))).sum(dtype=U64).view(np.int64)))
                        k2.append(int(np.bitwise_xor.reduce(own * U64(0x9FB21C651E98DF25) ^ (own >> U64(31))).view(np.int64)))
                        sig.append(_signature(own))
                    else:
                        k1.append(None)
                        k2.append(None)
                        sig.append(np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.array(n, pa.int64()), pa.array(k1, pa.int64()),
                     pa.array(k2, pa.int64()), pa.array(sig, pa.list_(pa.int64()))],
                    ["id", "n_shingles", "k1", "k2", "sig"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "id long, n_shingles long, k1 long, k2 long, sig array<long>")


def shingle_sets(docs: DataFrame, words: int = 5) -> DataFrame:
    """(id, shingles) with the whole set of each text of (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in byte_chunks(batch.column(1)):
                h, at = shingle_hashes(data, offsets, words)
                sets = [np.unique(h[a:b]).view(np.int64) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.array(sets, pa.list_(pa.int64()))],
                    ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles array<long>")


def _postings(reps: DataFrame, least: int) -> DataFrame:
    """(key, id, pop): each signature's rarest entries, as far as others have them too.

    Two signatures with ``least`` common entries share one among the
    COORDINATES - least + 1 rarest of each.
    Entries are ordered by frequency, so passages that many texts share stay
    out of the prefix of all texts that have enough of their own. Here and
    below, aggregates are written before they are joined back: beside a table,
    unlike beside an aggregate of the same stage, Spark splits a hot key.
    """
    every = reps.select("id", F.explode("sig").alias("key"))
    common, _ = stored(every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    each = every.join(common, "key").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("n", "key"))).alias("e"), F.sum("n").alias("pop"))
    rare = F.size("e") - (least - 1)
    return (each.where(rare > 0)
            .select("id", "pop", F.explode(F.slice("e", 1, F.greatest(rare, F.lit(1)))).alias("e"))
            .select(F.col("e.key").alias("key"), "id", "pop").distinct())


def _open(postings: DataFrame) -> DataFrame:
    """Postings that still hold several components, with their number of members m."""
    state, _ = stored(postings.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi").select("key", "m"))
    return postings.join(state, "key")


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets (id, shingles) have enough in common."""
    sets = sets.select("id", "shingles")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
            .select("a", "b", common.alias("common"),
                    (F.size("set_a") + F.size("set_b") - common).alias("either"))
            .where(F.lit(100) * F.col("common") >= F.lit(percent) * F.col("either"))
            .select("a", "b"))


def _starred(live: DataFrame, reps: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of each posting's most shared signature with its other members.

    Common coordinates are counted first; pairs with enough are compared on full sets.
    """
    center, _ = stored(live.groupBy("key").agg(F.min(F.struct((-F.col("pop")).alias("pop"), "id")).alias("c")))
    met = (live.join(center, "key").where("id <> c.id")
           .select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct())
    sig = reps.select("id", "sig")
    near, at = stored(met.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
                      .where(F.size(F.array_intersect("sig_a", "sig_b")) >= matches(percent)).select("a", "b").distinct())
    ids = near.select(F.col("a").alias("id")).union(near.select("b")).distinct()
    return _alike(near, shingle_sets(texts.join(ids, "id", "left_semi"), words), percent)


def _rest(live: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """All links between different components among the members (id, comp) of the open postings.

    A second prefix filter, on full sets and exact: shingles are ordered by
    frequency, and of two alike texts the first common shingle stands early in
    both. The larger text probes size classes, the smaller one is indexed, and
    places that leave too few shingles behind them are not posted. Copies of
    one original that are too far from it therefore don't meet each other.
    """
    members = live.groupBy("id").agg(F.min("comp").alias("comp"))
    sets, _ = stored(shingle_sets(texts.join(members, "id", "left_semi"), words).join(members, "id"))
    share = percent / (100 + percent)

    def least(n: Column, m: Column) -> Column:
        """Common shingles that sets of sizes n and m need, a rounding error fewer."""
        return F.ceil(F.lit(share) * (n + m) - 1e-6)

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / math.log(CLASS) + 1e-9)

    n, i = F.col("n"), F.col("i")
    each = sets.select("id", "comp", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    common, _ = stored(each.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    own = each.join(common, "s").groupBy("id", "comp", "n").agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("e"))
    # Shingles that nobody else has come first; they need no posting.
    alone = n - F.size("e")
    reach = F.floor(n * (1 - percent / 100) + 1e-6) + 1 - alone
    posts = (own.where(reach > 0).select("id", "comp", "n", alone.alias("alone"), F.posexplode(F.slice("e", 1, F.greatest(reach, F.lit(1)).cast("int"))).alias("j", "e"))
             .select("id", "comp", "n", (F.col("alone") + F.col("j")).alias("i"), F.col("e.s").alias("s")))
    index = posts.where(i <= n - least(n, n)).withColumn("k", size_class(n))
    index, _ = stored(index)
    state, _ = stored(index.groupBy("s", "k").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")))
    probe = (posts.withColumn("k", F.explode(F.sequence(size_class(F.greatest(n * (percent / 100), F.lit(1))), size_class(n))))
             .where(i <= n - least(n, F.pow(F.lit(CLASS), F.col("k")) - 1e-6)))
    probe, _ = stored(probe.join(state, ["s", "k"]).where("lo <> comp or hi <> comp").drop("lo", "hi"))
    other = index.select("s", "k", *[F.col(c).alias(f"{c}2") for c in ("id", "comp", "n", "i")])
    left = F.least(n - i, F.col("n2") - F.col("i2"))
    met = (probe.join(other, ["s", "k"])
           .where((F.col("comp") != F.col("comp2")) & (F.struct("n", "id") > F.struct("n2", "id2")) & (left >= least(n, F.col("n2"))))
           .select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct())
    return _alike(met, sets, percent)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Rows with equal shingle sets form a class named by its smallest id.
    Class signatures are posted under each (coordinate, value) of their prefix,
    which is long enough for pairs with fewer common coordinates than
    matches(percent) to meet as well (UNSEEN). In each posting the most shared
    signature meets all others; common coordinates are counted, pairs with
    matches(percent) of them are compared on full sets, and components are
    joined. Postings that then lie in one component are done; what is left in
    the others goes through an exact prefix join on full sets, however few
    coordinates agree, so a large group of copies is never compared pair by pair.

    Ids that occur in several rows count as one document. Rows without words
    (NULL, empty) link with nothing; rows without id link with nothing, have a
    NULL component and are kept. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    all_rows, _ = stored(sketches(docs, id_col, text_col, words))
    classes, _ = stored(all_rows.where("id is not null and k1 is not null").groupBy("k1", "k2").agg(F.min("id").alias("rep")))
    reps = (all_rows.where("id is not null").join(classes, ["k1", "k2"]).where("id = rep").select("id", "sig"))
    live, _ = stored(_postings(reps, matches(percent, UNSEEN)))
    near, _ = stored(_starred(live, reps, texts, words, percent))
    found = components(near).withColumnRenamed("component_id", "comp")
    live = live.select("key", "id").join(found, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    live, at = stored(live)
    live, at = stored(_open(live))
    if at["rows"]:
        more, _ = stored(_rest(live, texts, words, percent))
        near = near.union(more)
    # Copies hang on their class; an id with several texts joins its classes.
    links = all_rows.where("id is not null").join(classes, ["k1", "k2"]).select(
        F.col("id").alias("a"), F.col("rep").alias("b"))
    joined = components(near.union(_tied(links)))
    out = all_rows.join(classes, ["k1", "k2"], "left")
    out = out.join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "rep", "id"))
    return out.select("id", "n_shingles", component.alias("component_id")).select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _tied(links: DataFrame) -> DataFrame:
    """Of (id, its class), the ids of several rows that belong to more than one class."""
    several = links.groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).where("lo < hi")
    return links.join(several.select("a"), "a", "left_semi")
