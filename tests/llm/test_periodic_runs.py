"""Periodic runs against brute force over all periods."""

import random
import re

import pytest

from heatmart.llm import periodic_runs as op
from heatmart.llm.queries import planted


def brute(w):
    """(start, length, period) of every run, by trying all periods."""
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            a = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - a + q >= max(24, 3 * q):
                found.setdefault((a - q, i - a + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def check(spark, docs, rows):
    got = sorted((repr(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in op.periodic_runs(docs(rows)).collect())
    want = []
    for i, text in rows:
        w = words(text)
        runs = brute(w)
        dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((repr(i), len(w), runs, " ".join(x for k, x in enumerate(w) if k not in dropped)))
    assert got == sorted(want)
    return sum(len(r) for _, _, r, _ in want)


def text(r):
    letters = ["a", "b", "c", "é", "longer"][:r.choice([1, 2, 3, 5])]
    out = []
    for _ in range(r.randrange(6)):
        if r.random() < 0.6:
            unit = r.choices(letters, k=r.choice([1, 2, 3, 7, 8, 15, 16, 17, 31, 40, 100]))
            out += (unit * 20)[:r.randrange(1, 9 * len(unit))]
        else:
            out += r.choices(letters, k=r.randrange(60))
    return r.choice([" ", "\n", " \t "]).join(out)


@pytest.mark.parametrize("seed", range(5))
def test_random_texts_against_brute_force(spark, docs, seed):
    r = random.Random(seed)
    rows = [(i, text(r)) for i in range(60)]
    assert check(spark, docs, rows) > 20


def test_long_runs_cross_tiles_and_shares(spark, docs):
    r = random.Random(5)
    unit = [f"w{r.randrange(50)}" for _ in range(300)]
    far = [f"u{i}" for i in range(900)]
    rows = [(1, " ".join("x" for _ in range(5000))), (2, " ".join((unit * 12)[17:3333])), (3, " ".join(far * 3)), (4, " ".join((far * 3)[:-1])),
            (5, " ".join(["a", "b"] * 1000 + ["c"] + ["a", "b"] * 1000)), (6, "y " * 23), (7, "y " * 24), (8, "p q r s t u v w " * 3)]
    assert check(spark, docs, rows) >= 7


def test_nulls_empty_and_repeated_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n "), (None, "z " * 30), (None, "z " * 30), (4, "k l " * 20), (4, "k l " * 20), (4, "m " * 25), (5, "one")]
    assert check(spark, docs, rows) == 5
    assert op.periodic_runs(docs(rows).where("false")).collect() == []


def test_planted_loops(spark, docs):
    import zlib
    r = random.Random(2)
    rows = [(i, " ".join(r.choices("abcdefgh", k=r.randrange(80)))) for i in range(200)] + [(201, None), (None, "x y z")]
    want = {}
    for i, t in rows:
        w = words(t)
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if i is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        want[i] = w
    got = {x["doc_id"]: words(x["text"]) for x in planted(docs(rows)).collect()}
    assert got == want
    assert check(spark, docs, [(i, " ".join(w)) for i, w in want.items()]) > 0


def test_every_run_lies_in_its_tiles():
    r = random.Random(3)
    for _ in range(300):
        w = words(text(r))
        data = " ".join(w).encode()
        chunk = op.Chunk(op.np.frombuffer(data, op.np.uint8), op.np.array([0, len(data)]))
        tiles = [t[1:] for t in chunk.tiles()]
        for s, n, q in brute(w):
            scale = max(16, 1 << q.bit_length())
            assert any(k == scale and any(s <= c <= s + n - q for c in range(a, b + 1, k)) for k, _, a, b, _ in tiles)
