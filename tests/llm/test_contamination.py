"""Decontamination against brute force over every window."""

import random
import re

import numpy as np
import pytest

from heatmart.llm import contamination as op

ITEM = "item_id long, text string"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    """n_words, hit words, and each item's longest match as (item, item start, start, length)."""
    w = tokens(text)
    hit, best = set(), []
    for row, (item, own) in enumerate(items):
        v = tokens(own)
        size = min(len(v), 10)
        longest = None
        for i in range(len(w)):
            for j in range(len(v)):
                n = 0
                while i + n < len(w) and j + n < len(v) and w[i + n] == v[j + n]:
                    n += 1
                if n >= size:
                    hit.update(range(i, i + n))
                    if not (i and j and w[i - 1] == v[j - 1]):
                        longest = min(longest or (0, 0, 0), (-n, i, j))
        if longest:
            best.append((None if item is None else str(item), longest[2], longest[1], -longest[0]))
    return len(w), len(hit), sorted(best, key=repr)


def check(spark, docs, rows, items):
    found = op.contamination(docs(rows), spark.createDataFrame(items, ITEM)).collect()
    assert len(found) == len(rows)
    got = sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], sorted(map(tuple, r["matches"]), key=repr), r["contaminated"]) for r in found)
    want = [(i, *brute(t, items)) for i, t in rows]
    assert got == sorted((repr(i), n, h, m, h > 0) for i, n, h, m in want)
    for r in found:
        covered = [k for s in r["spans"] for k in range(s["start"], s["start"] + s["length"])]
        assert len(covered) == len(set(covered)) == r["n_hit"]


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_against_brute_force(spark, docs, seed):
    r = random.Random(seed)
    letters = ["a", "B", "b", "ça", "x1", "Ω", "zz"][:r.choice([2, 3, 7])]
    items = [(r.choice([1, 2, 30, None]), " ".join(r.choices(letters, k=r.choice([0, 1, 2, 9, 10, 11, 40])))) for _ in range(6)]
    rows = []
    for i in range(12):
        text = "".join(w + r.choice([" ", ", ", "\n", "'"]) for w in r.choices(letters, k=r.choice([0, 1, 5, 30, 80])))
        if r.random() < 0.5:
            text += " " + r.choice(items)[1] + " tail"
        rows.append((r.choice([i, 3, None]), text))
    check(spark, docs, rows, items)


def test_several_blocks_give_the_same(spark, docs, monkeypatch):
    r = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choices(words, k=25))) for i in range(20)]
    rows = [(i, " ".join(r.choices(words, k=20)) + " " + r.choice(items)[1] + " " + r.choice(items)[1][10:]) for i in range(15)]
    monkeypatch.setattr(op, "BLOCK", 300)
    monkeypatch.setattr(op, "SHARD", 500)
    check(spark, docs, rows, items)
    left = op.decontaminated(docs(rows + [(99, "w1 w2 free")]), spark.createDataFrame(items, ITEM))
    assert [x["doc_id"] for x in left.collect()] == [99]


def test_nulls_empty_tables_long_and_repeated_texts(spark, docs):
    passage = " ".join(f"t{i}" for i in range(30))
    long = "filler words go on " * 60_000 + passage + " and on " * 1000
    rows = [(1, None), (2, ""), (3, "..."), (4, long), (4, long), (None, passage.upper()), (5, passage.replace("t15", "u15"))]
    items = [(7, passage), (7, passage), (None, passage), (8, None), (9, "")]
    found = op.contamination(docs(rows), spark.createDataFrame(items, ITEM)).collect()
    by = sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], len(r["matches"])) for r in found)
    assert by == sorted([("1", 0, 0, 0), ("2", 0, 0, 0), ("3", 0, 0, 0), ("4", 242030, 30, 3), ("4", 242030, 30, 3), ("None", 30, 30, 3), ("5", 30, 29, 3)])
    assert {tuple(m) for r in found if r["doc_id"] == 4 for m in r["matches"]} == {("7", 0, 240000, 30), (None, 0, 240000, 30)}
    none = op.contamination(docs(rows), spark.createDataFrame([], ITEM)).collect()
    assert len(none) == len(rows) and not any(r["contaminated"] for r in none)
    assert op.contamination(docs(rows).where("false"), spark.createDataFrame(items, ITEM)).collect() == []


def test_removal_keeps_clean_rows_and_their_columns(spark, docs):
    passage = " ".join(f"t{i}" for i in range(12))
    table = docs([(1, "clean"), (2, f"x {passage} y"), (3, None), (4, " ".join(f"t{i}" for i in range(9)))])
    left = op.decontaminated(table, spark.createDataFrame([(1, passage)], ITEM))
    assert left.schema == table.schema
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3, 4]


def test_suffixes_are_in_order():
    rng = np.random.default_rng(1)
    symbols = np.concatenate([rng.integers(0, 3, 3000), np.zeros(2 * op.WINDOW, int)]).astype(np.int32)
    for bits in (2, 10, 31):
        order, _, _ = op.suffix_array(symbols, bits)
        # what follows a foreign word makes no difference to any window
        rows = [tuple(symbols[p:p + op.WINDOW]) for p in order]
        cut = [r[:r.index(0)] if 0 in r else r for r in rows]
        assert cut == sorted(cut) and len(order) == (symbols > 0).sum()
