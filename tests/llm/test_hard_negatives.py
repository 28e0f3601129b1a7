"""Hard negatives against brute force over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from heatmart.llm import hard_negatives as op

ROWS = "vec_id long, label int, vector array<long>, score string, key int"


def brute(rows, every):
    fit = [r for r in rows if None not in r and None not in r[2]]
    out = []
    for a, label, v in fit:
        if a % every:
            continue
        scored = [(max(min(sum(x * y for x, y in zip(v, w)), op.LONG), -op.LONG - 1), i, m)
                  for i, m, w in fit if len(w) == len(v)]
        best = sorted((-s, i) for s, i, m in scored if m == label and i != a)[:5]
        for s, p in best:
            inside = sorted((-n, i) for n, i, m in scored if m != label and -50 * s <= 100 * n <= -95 * s)[:3]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, every, parts=5):
    table = spark.createDataFrame([(*r, "x", 0) for r in rows], ROWS).repartition(parts)
    return sorted(map(tuple, op.hard_negatives(table, F.col("vec_id") % every == 0).collect()))


def some(seed, n, size, most):
    r = random.Random(seed)
    return [(i, r.randrange(3), [r.randint(-most // 4, most) for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("seed,n,size,most", [(1, 300, 8, 60), (2, 200, 3, 4), (3, 120, 2, 10 ** 9), (4, 200, 1, 5 * 10 ** 9), (5, 400, 1, 2)])
def test_against_all_pairs(spark, seed, n, size, most):
    rows = some(seed, n, size, most)
    assert mined(spark, rows, 10) == brute(rows, 10)
    assert brute(rows, 10)


def test_blocks_of_anchors_and_pieces_of_scores(spark, monkeypatch):
    rows = some(7, 250, 6, 50)
    monkeypatch.setattr(op, "BLOCK", 1000)
    monkeypatch.setattr(op, "SCORES", 64)
    assert mined(spark, rows, 5) == brute(rows, 5)


def test_nulls_ties_repeats_lengths_and_empty_tables(spark):
    rows = some(8, 60, 4, 20)
    rows += [(None, 1, [1] * 4), (70, None, [9] * 4), (80, 1, None), (90, 1, [1, None, 2, 3]), (100, 1, []), (101, 1, []), (102, 2, []),
             (110, 1, [5, 6]), (111, 1, [5, 6]), (112, 2, [5, 4]), (-10, 0, [9, 9, 9, 9])]
    rows += rows[10:30] + [(20, 2, [3, 3, 3, 3])]
    assert mined(spark, rows, 10) == brute(rows, 10)
    assert mined(spark, [r for r in rows if r[0] is None or r[0] % 10], 10) == []
    assert mined(spark, [], 10) == []
    # one label only: no negatives
    assert mined(spark, [(i, 1, [i, 1]) for i in range(30)], 10) == []


def test_a_task_keeps_few_rows_of_each_slot():
    best = op.Best(2, 3)
    for start in range(0, 1000, 10):
        best.offer(*(op.np.array(x) for x in ([0] * 10, [start // 100] * 10, list(range(start, start + 10)))))
    assert best.id.tolist() == [900, 901, 902] and best.score.tolist() == [9, 9, 9]
