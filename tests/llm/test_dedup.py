"""Near-duplicate vectors and texts, and repeated passages, against brute force."""

import hashlib
import itertools
import math
import random
import re

import numpy as np

from heatmart.llm import common, embedding_dedup, minhash_dedup, repeats
from heatmart.llm.components import components
from heatmart.llm.hnsw import Graph


def reached(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text):
    low = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    w = re.findall(rb"[^\x20\x09-\x0d]+", low)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def expected_groups(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, reached(sets, links)


def check_texts(docs, rows, percent=85):
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs(rows), percent=percent).collect()}
    sets, groups = expected_groups(rows, percent)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), groups[i], groups[i] == i) for i in sets}


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(600, 700)] + [(7, 7)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect())
    edges = [e for e in edges if e[0] != e[1]]
    assert got == reached({x for e in edges for x in e}, edges)


def test_near_texts_with_edits_copies_and_edge_cases(docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 10
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(4, 120))]
        for _ in range(rng.randrange(1, 5)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((i, rng.choice([" ", "  ", "\n"]).join(own)))
            i += 7
    rows += [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one TWO"), (6, "One  two\n"), (8, "É b c d e f"), (9, "é b c d e f")]
    check_texts(docs, rows)


def thue_morse(letters, doublings):
    word = letters[0]
    for _ in range(doublings):
        word += word.translate(str.maketrans(letters, letters[::-1]))
    return word


def test_mixed_hashes_tell_words_apart():
    rng = random.Random(6)
    some = ["".join(rng.choice("abAB\0é") for _ in range(rng.randrange(1, 28))) for _ in range(3000)]
    some += [thue_morse(p, n) for p in ("ab", "ba") for n in range(1, 14)] + ["x" * n for n in range(1, 70)]
    some += ["a" * 8 + "b" * 8, "b" * 8 + "a" * 8, "a" * 16, "a" * 8 + "\0" * 8]
    texts = [" ".join(some[:50]), "", *some[50:], " "]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    hashes, first = common.mixed_word_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)
    low = [w.encode().lower() for w in some]
    assert len(hashes) == len(low) and first[1] == first[2] == 50
    assert len(set(hashes.tolist())) == len(set(low)) == len(set(zip(low, hashes.tolist())))
    assert [len(x) for x in common.mixed_word_hashes(np.zeros(0, np.uint8), np.zeros(2, np.int64))] == [0, 2]


def test_mirrored_words_of_few_letters_are_not_copies(docs):
    check_texts(docs, [(1, thue_morse("ab", 10)), (2, thue_morse("ba", 10)), (3, thue_morse("ab", 10).upper())])


def test_large_group_of_near_copies_with_stragglers(docs):
    rng = random.Random(2)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
    rows = []
    for i in range(160):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((1000 - i, " ".join(own)))
    check_texts(docs, rows)


def test_isolated_pairs_at_the_limit_of_the_pipeline(spark, docs):
    import corpus_pipeline

    rows, expected, seen = [], set(), {}
    for i in range(6000):
        # 40 of 50 shingles in common; of every eighth pair 39 of 49.
        common = " ".join(f"c{i}x{k}" for k in range(43 if i % 8 == 7 else 44))
        pair = [(2 * i + j, common + "".join(f" t{i}x{j}x{k}" for k in range(5))) for j in range(2)]
        a, b = (shingles(t) for _, t in pair)
        assert all(seen.setdefault(s, i) == i for s in a | b)
        near = 100 * len(a & b) >= 80 * len(a | b)
        assert near == (i % 8 != 7)
        expected |= {2 * i} if near else {2 * i, 2 * i + 1}
        rows += pair
    left = corpus_pipeline.near_duplicates(spark, docs(rows), "")
    assert {r.doc_id for r in left.select("doc_id").collect()} == expected


def borderline_pair(i, shared):
    """Two texts of unused words, of 20 shingles and the first ``shared`` of them."""
    words = [f"s{i}x{k}" for k in range(24)]
    return " ".join(words), " ".join(words[:shared + 4])


def test_pairs_at_the_limit_are_linked_however_few_coordinates_agree(docs):
    # Found by search: pairs of 17 of 20 shingles that agree on fewer than the 30 asked coordinates.
    few = [88583, 96905, 128724, 131419, 133339, 261128, 267213, 277388, 285584]
    rows = [(2 * i + j, t) for i in few for j, t in enumerate(borderline_pair(i, 17))]
    sig = {r.id: set(r.sig) for r in minhash_dedup.sketches(docs(rows)).collect()}
    assert max(len(sig[2 * i] & sig[2 * i + 1]) for i in few) < minhash_dedup.matches(85)
    more = range(300_000, 304_000)
    shared = {i: 17 - (i % 5 == 0) for i in more}
    rows += [(2 * i + j, t) for i in more for j, t in enumerate(borderline_pair(i, shared[i]))]
    left = {r.component_id for r in minhash_dedup.near_duplicates(docs(rows), percent=85).collect()}
    assert left == {2 * i for i in [*few, *more]} | {2 * i + 1 for i in more if shared[i] == 16}


def test_needed_coordinates_follow_the_similarity():
    assert [minhash_dedup.matches(p) for p in (80, 85, 100)] == [26, 30, 48]
    assert [minhash_dedup.matches(p, minhash_dedup.UNSEEN) for p in (80, 85, 100)] == [16, 20, 48]
    for p in (50, 80, 85, 95):
        fewer = sum(math.comb(48, k) * (p / 100) ** k * (1 - p / 100) ** (48 - k) for k in range(minhash_dedup.matches(p)))
        assert fewer <= minhash_dedup.LOSS


def test_common_passage_alone_links_nothing(docs):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) + " " + passage) for i in range(80)]
    check_texts(docs, rows)


def test_rows_without_id_and_repeated_ids(docs):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    got = minhash_dedup.near_duplicates(docs([(None, a), (1, a), (2, a), (2, b), (3, b), (3, b)])).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [
        (0, None, True), (1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (3, 1, False)]
    assert minhash_dedup.near_duplicates(docs([])).count() == 0


def test_graph_search_finds_what_full_comparison_finds():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16))
    v = np.concatenate([centres[i % 60] + rng.normal(size=16) * 0.05 for i in range(1500)]).reshape(-1, 16)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = Graph.unpack(Graph.build(v.astype(np.float32), np.arange(len(v))).audit(0.98).pack())
    q, node = graph.within(graph.vectors, 0.98)
    got = set(zip(graph.ids[q].tolist(), graph.ids[node].tolist()))
    exact = np.argwhere(v @ v.T >= 0.98 + 1e-5)
    assert len({tuple(x) for x in exact.tolist()} - got) <= 0.01 * len(exact)


def test_near_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(6)
    rows, i = [], 0
    for label in (0, 1):
        for _ in range(25):
            c = rng.normal(size=8)
            for _ in range(rng.integers(1, 5)):
                rows.append((i, [float(x) for x in (c + rng.normal(size=8) * 0.07).astype(np.float32)], label))
                i += 1
    rows += [(i + k, rows[3][1], rows[3][2]) for k in range(5)]
    n = len(rows)
    odd = [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [float("nan")] + [1.0] * 7, 0), (n + 3, rows[3][1], None),
           (n + 4, [None] + [1.0] * 7, 0), (n + 5, [], 0), (n + 6, [float("inf")] + [1.0] * 7, 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    links = []
    for (a, va, la), (b, vb, lb) in itertools.combinations(rows, 2):
        x, y = np.array(va), np.array(vb)
        if la == lb and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
            links.append((a, b))
    groups = reached([r[0] for r in rows + odd], links)
    count = {r[0]: sum(r[0] in x for x in links) for r in rows + odd}
    for shard in (8192, 16):
        got = embedding_dedup.near_vectors(frame, shard_rows=shard).collect()
        assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {
            (k, count[k], groups[k], groups[k] == k) for k in groups}
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_ids_of_several_vectors_keep_their_links_apart(spark):
    def at(angle):
        return [float(np.cos(angle)), float(np.sin(angle))]
    # Id 1 has two near vectors and one far off, which has a partner of its own; in label 1 it has none.
    rows = [(1, at(0.0), 0), (1, at(0.1), 0), (1, at(1.5), 0), (2, at(1.55), 0), (3, at(2.5), 0), (1, at(2.5), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_vectors(frame).collect())
    assert got == [(1, 0, 1), (1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)]


def expected_removal(rows):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            w = data[p:p + 100]
            if w in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def removal_rows():
    rng = random.Random(7)
    def text(n):
        return "".join(rng.choice("abcdeé 中\n") for _ in range(n))
    shared = [text(150), text(99), text(101), "ab" * 200, "x" * 330]
    rows = [(i, text(rng.randrange(0, 300)) + rng.choice(shared) + text(rng.randrange(0, 120)) + rng.choice(shared)) for i in range(60)]
    near = text(700)
    for i in range(60, 90):
        at = rng.randrange(700)
        rows.append((i, near[:at] + rng.choice("Zé") + near[at + rng.randrange(2):]))
    return rows + [(100, None), (101, ""), (102, "x" * 100), (103, "x" * 99), (104, near), (105, near)]


def test_repeats_against_all_windows(docs, monkeypatch):
    rows = removal_rows()
    expected = expected_removal(rows)
    for limits in ({}, {"CROWD": 3}, {"SORTED": 10}, {"SEGMENT": 256}):
        for name, value in limits.items():
            monkeypatch.setattr(repeats, name, value)
        got = repeats.digests(docs(rows)).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == expected, limits
        monkeypatch.undo()


def test_repeats_of_equal_rows_missing_ids_and_kept_columns(docs):
    rng = random.Random(8)
    t = "".join(rng.choice("abcdefgh") for _ in range(240))
    got = repeats.without_repeats(docs([(None, t), (1, t), (2, t[:50] + "é" * 40), (2, t), (2, t)]), keep_columns=True, as_text=True)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", *repeats.RESULT]
    assert sorted((r.doc_id or 0, r.n_removed) for r in got.collect()) == [(0, 0), (1, 240), (2, 0), (2, 240), (2, 240)]
    assert repeats.digests(docs([])).count() == 0
