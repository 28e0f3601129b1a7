"""Scoring, quality, packing and the pipeline."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heatmart.llm import cotraining, masked_lm, packing
from heatmart.llm.common import word_hashes


def sentences(n, seed):
    rng = random.Random(seed)
    nouns, verbs = ["cat", "dog", "bird", "fish"], ["sees", "hears", "likes"]
    return [" ".join(f"the {rng.choice(nouns)} {rng.choice(verbs)} a {rng.choice(nouns)} ." for _ in range(12)) for _ in range(n)]


def test_network_gradient_matches_differences():
    rng = np.random.default_rng(1)
    net = masked_lm.Net((rng.normal(size=masked_lm.SIZE) * 0.3).astype(np.float32))
    context = rng.integers(0, masked_lm.BUCKETS + 1, (40, 2 * masked_lm.SIDE))
    word = rng.integers(0, masked_lm.BUCKETS, 40)
    g = net.gradient(context, word)
    for at in np.argsort(-np.abs(g))[[0, 5, 50, 200, 900]]:
        up, down = (masked_lm.Net(net.flat + np.eye(1, masked_lm.SIZE, at, dtype=np.float32)[0] * e) for e in (0.02, -0.02))
        slope = -(up.log_prob(context, word).mean() - down.log_prob(context, word).mean()) / 0.04
        assert slope == pytest.approx(float(g[at]), rel=0.1, abs=2e-4)
    p = np.exp(net.log_prob(np.repeat(context[:1], masked_lm.BUCKETS, 0), np.arange(masked_lm.BUCKETS)))
    assert p.sum() == pytest.approx(1, abs=1e-3)


def test_masked_scores_prefer_what_the_corpus_says(spark, docs, monkeypatch):
    for name, value in (("STRIDE", 2), ("BATCH", 32), ("RATE", 0.02)):
        monkeypatch.setattr(masked_lm, name, value)
    corpus = docs(list(enumerate(sentences(400, 2))))
    model = masked_lm.train(corpus, rounds=3)
    good = sentences(1, 99)[0]
    mixed = good.split()
    random.Random(3).shuffle(mixed)
    rows = [(1, good), (2, " ".join(mixed)), (3, None), (4, ""), (4, good), (5, "word " * 50_000)]
    got = masked_lm.scored(spark, docs(rows), *model).collect()
    mean = {(r.doc_id, r.n_words): r.mean_log_prob for r in got}
    assert mean[1, 72] > mean[2, 72] + 0.2 and mean[4, 72] == pytest.approx(mean[1, 72])
    assert mean[3, 0] is None and mean[4, 0] is None and (5, 50_000) in mean
    flat, rank = masked_lm.train(docs([]))
    assert masked_lm.scored(spark, docs([]), flat, rank).count() == 0


def test_every_word_is_a_training_target(monkeypatch):
    texts = [" ".join(f"w{i}x{k}" for k in range(i % 23)) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    rank, start = np.arange(masked_lm.BUCKETS), np.zeros(masked_lm.SIZE, np.float32)
    seen = np.zeros(masked_lm.BUCKETS, np.int64)

    def gradient(net, context, word):
        seen[:] += np.bincount(word, minlength=masked_lm.BUCKETS)
        return np.zeros(masked_lm.SIZE, np.float32)
    monkeypatch.setattr(masked_lm.Net, "gradient", gradient)
    for turn in range(masked_lm.ROUNDS):
        list(masked_lm._trained(start, rank, turn)(iter([batch])))
    words = next(masked_lm._tokens(batch.column(0), rank))[2]
    assert (seen == np.bincount(words, minlength=masked_lm.BUCKETS)).all()


def test_production_settings_learn_from_a_corpus(spark, docs):
    model = masked_lm.train(docs(list(enumerate(sentences(12_000, 2))), 2))
    rows = []
    for i, good in enumerate(sentences(40, 99)):
        mixed = good.split()
        random.Random(i).shuffle(mixed)
        rows += [(2 * i, good), (2 * i + 1, " ".join(mixed))]
    mean = {r.doc_id: r.mean_log_prob for r in masked_lm.scored(spark, docs(rows), *model).collect()}
    assert all(mean[2 * i] > mean[2 * i + 1] + 0.5 for i in range(40))


def test_words_of_one_bucket_differ_by_their_counts(spark, docs, monkeypatch):
    def hashed(ws):
        return word_hashes(np.frombuffer(" ".join(ws).encode(), np.uint8), np.array([0, len(" ".join(ws))]))[0]
    pool = [f"j{i}" for i in range(20_000)]
    the, *others = hashed(["the", *pool]) % masked_lm.U64(masked_lm.BUCKETS)
    rare, junk = [w for w, b in zip(pool, others) if b == the][:2]
    corpus = sentences(60, 4)
    corpus[0] += " " + rare
    counts = Counter(w for t in corpus for w in t.split())
    texts = [f"a {w} sees ." for w in ("the", rare, junk)] + [sentences(1, 5)[0] + " " + junk]
    for frequent in (masked_lm.FREQUENT, 4):
        monkeypatch.setattr(masked_lm, "FREQUENT", frequent)
        flat, words = masked_lm.train(docs(list(enumerate(corpus))))
        assert words.table.count() == len(counts) and len(words.common) < frequent
        got = {r.doc_id: r for r in masked_lm.scored(spark, docs(list(enumerate(texts))), flat, words).collect()}
        assert got[0].log_prob > got[1].log_prob > got[2].log_prob
        net, kinds = masked_lm.Net(flat), list(counts)
        bucket = words.rank[(hashed(kinds) % masked_lm.U64(masked_lm.BUCKETS)).astype(np.int64)]
        for i, t in enumerate(texts):
            own = words.rank[(hashed(t.split()) % masked_lm.U64(masked_lm.BUCKETS)).astype(np.int64)]
            places = np.arange(len(own))
            expected = net.log_prob(masked_lm._contexts(own, np.array([0, len(own)]), places), own).astype(float)
            for k, w in enumerate(t.split()):
                peers = [counts[x] for x, b in zip(kinds, bucket) if b == own[k]]
                expected[k] += np.log((counts[w] + 0.5) / (sum(peers) + 0.5 * (len(peers) + 1)))
            assert got[i].log_prob == pytest.approx(expected.sum(), rel=1e-5)


def test_as_many_frequent_words_are_sent_as_may_be(spark, docs, monkeypatch):
    monkeypatch.setattr(masked_lm, "FREQUENT", 200)
    counts = {f"w{i}": 300 - i for i in range(300)}
    texts = [" ".join([w] * n) for w, n in counts.items()]
    flat, words = masked_lm.train(docs(list(enumerate(texts))), rounds=1)
    assert 190 <= len(words.common) < 200
    assert sorted(words.times, reverse=True) == sorted(counts.values(), reverse=True)[:len(words.common)]
    assert words.table.where(F.col("n") >= words.least).count() == len(words.common)


def test_lookup_finds_hashes_that_share_their_first_bits():
    rng = np.random.default_rng(4)
    known = np.unique(np.concatenate([rng.integers(0, 2 ** 64, 300, np.uint64), np.uint64(7) + np.arange(40, dtype=np.uint64),
                                      np.array([0, 2 ** 64 - 1], np.uint64)]))
    place, found = masked_lm.Lookup(known).find(known)
    assert found.all() and (place == np.arange(len(known))).all()
    others = np.setdiff1d(np.concatenate([known + np.uint64(1), known - np.uint64(1)]), known)
    assert not masked_lm.Lookup(known).find(others)[1].any()
    assert not masked_lm.Lookup(known[:0]).find(known)[1].any()


def plain_training(start, words, contexts):
    """Steps of Adam in double precision, one by one, with the whole softmaxes."""
    flat, first, second = start.astype(float), 0.0, 0.0
    for step, i in enumerate(range(0, len(words), masked_lm.BATCH), 1):
        net, g, own = masked_lm.Net(flat), masked_lm.Net(np.zeros(masked_lm.SIZE)), words[i:i + masked_lm.BATCH]
        for context, w in zip(contexts[i:i + masked_lm.BATCH], own):
            x = net.emb[context].ravel()
            h = np.tanh(x @ net.inner + net.inner_b)
            back = np.zeros(masked_lm.HIDDEN)
            k, m = divmod(w, masked_lm.MEMBERS)
            for of, of_b, to, to_b, hit in ((net.cls[:-1], net.cls_b, g.cls[:-1], g.cls_b, k),
                                            (net.mem[k, :-1], net.mem_b[k], g.mem[k, :-1], g.mem_b[k], m)):
                p = np.exp(h @ of + of_b)
                p /= p.sum()
                p[hit] -= 1
                to += np.outer(h, p)
                to_b += p
                back += of @ p
            back *= 1 - h * h
            g.inner += np.outer(x, back)
            g.inner_b += back
            np.add.at(g.emb, context, (net.inner @ back).reshape(-1, masked_lm.WIDTH))
        slope = g.flat / len(own)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        flat = flat - masked_lm.RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return flat


def test_training_takes_the_plain_steps_and_hashes_once(monkeypatch):
    monkeypatch.setattr(masked_lm, "BATCH", 256)
    batch = pa.RecordBatch.from_arrays([pa.array([*sentences(12, 3), None, "", "one", " ".join(f"x{i}" for i in range(700))])], ["text"])
    rank = np.random.default_rng(2).permutation(masked_lm.BUCKETS)
    start = masked_lm.Net.start(np.arange(masked_lm.BUCKETS, 0, -1.0)).flat

    def weights(batches):
        return np.concatenate([b.column(1).to_numpy() / b.column(2).to_numpy() for b in masked_lm._trained(start, rank, 1)(batches)])
    _, _, words, at = next(masked_lm._tokens(batch.column(0), rank))
    places = np.arange(1, len(words), 2)
    places = places[np.argsort(masked_lm.noise(len(places), 1))]
    plain = plain_training(start, words[places], masked_lm._contexts(words, at, places))
    got = weights(iter([batch]))
    assert np.abs(plain - start).max() > 0.01 and np.abs(got - plain).max() < 1e-3 and np.abs(got - plain).mean() < 1e-6
    hashed = list(masked_lm._hashed(iter([batch])))
    monkeypatch.setattr(masked_lm, "word_hashes", None)
    assert (weights(b.select(["buckets", "first"]) for b in hashed if b.column(0)[0].is_valid) == got).all()
    assert sum(sum(b.column(3)[0].as_py()) for b in hashed if b.column(2)[0].is_valid) == len(words)


def test_scores_of_large_weights_fit():
    net = masked_lm.Net(np.zeros(masked_lm.SIZE, np.float32))
    net.cls_b[3], net.mem_b[3, 5] = 500, -300
    context = np.zeros((2, 2 * masked_lm.SIDE), np.int64)
    got = net.log_prob(context, np.array([3 * masked_lm.MEMBERS, 3 * masked_lm.MEMBERS + 5]))
    assert got == pytest.approx([-np.log(masked_lm.MEMBERS - 1), -300 - np.log(masked_lm.MEMBERS - 1)], rel=1e-5)


def quality_rows(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.25
        w = [rng.choice(["the", "of", "house", "tree", "runs", "green"]) for _ in range(rng.randrange(20, 80))]
        rows.append((i, " ".join(x.upper() + "!!" if bad else x for x in w)))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_quality_on_held_out_documents(spark, docs):
    rows, labels = quality_rows(600, 5)
    known = spark.createDataFrame(labels[:300] + [(None, 1), (5, None), (7, 1 - labels[7][1])], "doc_id long, quality int")
    extra = [(1000, None), (1001, ""), (None, "the house"), (1002, " ".join(quality_rows(2_000, 1)[0][k][1].lower().replace("!!", "") for k in range(1_000)))]
    table = docs(rows + extra)
    model = cotraining.learn(table, known)
    assert model.rounds and model.rounds[0][0] > 0
    got = {r.doc_id: r for r in cotraining.scored(table, model).collect()}
    assert len(got) == 604
    held = [(got[i].keep, y) for i, y in labels[300:]]
    assert sum(k == bool(y) for k, y in held) >= 0.98 * len(held)
    assert got[1002].keep and got[1002].kept == "x"


def test_quality_without_usable_labels_rejects_nothing(spark, docs):
    table = docs([(1, "a b"), (2, None)])
    for labels in ([], [(1, 1)], [(1, None)]):
        model = cotraining.learn(table, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert all(r.keep for r in cotraining.scored(table, model).collect())
    assert cotraining.scored(docs([]), model).count() == 0


def test_bucket_ends_have_the_least_padding():
    rng = np.random.default_rng(7)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
        counts = rng.integers(1, 50, 9)
        for k in (1, 2, 4, 20):
            ends = packing.boundaries(lengths, counts, k)

            def cost(e):
                return sum(c * min(x for x in e if x >= n) for n, c in zip(lengths, counts))
            best = min(cost((*x, lengths[-1])) for x in itertools.combinations(lengths[:-1], min(k, 9) - 1))
            assert len(ends) <= k and ends[-1] == lengths[-1] and cost(ends) == best


def test_batches_are_full_and_within_budget(docs):
    rng = random.Random(8)
    rows = [(i, "w " * rng.choice([1, 3, 5, 40, 41, 300])) for i in range(500)] + [(900, None), (901, " "), (None, "a b"), (3, "a b"), (3, "a b")]
    rows.append((902, "w " * 100_000))
    got = packing.packed(docs(rows), buckets=4, tokens=1000).toPandas()
    assert len(got) == len(rows) and not got.duplicated(["bucket", "batch", "place"]).any()
    assert (got.n_tokens <= got.padded).all() and set(got[got.n_tokens == 0].padded) == {0}
    for (bucket, padded), part in got.groupby(["bucket", "padded"]):
        size = max(1, 1000 // max(padded, 1))
        counts = part.groupby("batch").size().sort_index()
        assert list(counts.index) == list(range(len(counts))) and (counts.iloc[:-1] == size).all() and counts.iloc[-1] <= size
    assert packing.packed(docs([])).count() == 0


def test_cuts_of_many_long_lengths_are_exact():
    rng = np.random.default_rng(8)
    lengths = np.unique(rng.integers(2000, 10 ** 7, 700))
    counts = rng.integers(1, 10 ** 5, len(lengths))
    total = np.concatenate([[0], np.cumsum(counts)])
    best = lengths * total[1:]
    for k in range(2, 8):
        # the plain quadratic recurrence
        best = np.array([min([best[i]] + [best[j - 1] + lengths[i] * (total[i + 1] - total[j]) for j in range(1, i + 1)])
                         for i in range(len(lengths))])
        ends = np.array(packing.boundaries(lengths, counts, k))
        assert len(ends) <= k and (ends[np.searchsorted(ends, lengths)] * counts).sum() == best[-1]


def test_equal_rows_without_id_fill_batches(spark):
    rows = spark.range(0, 100_000, 1, 3).select(F.lit(None).cast("long").alias("doc_id"), F.lit("other").alias("extra"))
    got = packing.packed(rows, length=F.lit(3000), tokens=30_000).toPandas()
    assert len(got) == 100_000 and set(got.padded) == {3000} and not got.duplicated(["bucket", "batch", "place"]).any()
    assert (got.groupby("batch").size() == 10).all() and set(got.batch) == set(range(10_000))


def test_pipeline_keeps_columns_and_clean_documents(spark, docs, tmp_path):
    import corpus_pipeline

    rows, labels = quality_rows(300, 9)
    rows = [(i, t + f" unique{i} " + " ".join(f"u{i}x{k}" for k in range(30))) for i, t in rows]
    clean = next(i for i, y in labels if y)
    rows += [(2000, dict(rows)[clean]), (2001, None)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    table = docs(rows)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    now = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == table.columns, name
    left = {r.doc_id for r in now.collect()}
    assert clean in left and 2000 not in left
    good = {i for i, y in labels if y}
    assert left >= good and len(left - good - {2001}) <= 2
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == left
