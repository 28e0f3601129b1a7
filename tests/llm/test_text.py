"""Fingerprints, licenses, main text and encoding."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from heatmart.llm import bpe, licenses, main_text, syncmers
from heatmart.llm.queries import TOKENIZERS

VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.json"


def test_fingerprints_edits_and_next_texts(docs, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 7)
    rng = random.Random(1)
    rows = [(i * 3, " ".join(f"é{rng.randrange(50)}" for _ in range(rng.randrange(0, 90)))) for i in range(40)]
    rows += [(500, None), (501, ""), (502, "one two"), (503, "one\ttwo"), (504, rows[4][1])]
    got = {r.doc_id: r for r in syncmers.fingerprints(docs(rows)).collect()}
    ids = [i for i, _ in rows]
    text = {i: t or "" for i, t in rows}
    for k, i in enumerate(ids):
        own, other = text[i], text[ids[(k + 1) % len(ids)]]
        half = len(own) // 2
        edited = own[:len(own) - half] + other[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[504].fingerprint == got[12].fingerprint
    assert got[500].fingerprint == "" and got[500].near_next == 1.0
    assert got[502].near_next == 1.0
    assert syncmers.fingerprints(docs([])).count() == 0


def test_anchors_are_closed_syncmers_and_context_free(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(30)}" for _ in range(120)]
    frame = spark.createDataFrame([(" ".join(words),), (" ".join(["other", "start", *words[40:90]]),)], "t string")
    h = {r.w: r.h for r in frame.select(F.explode(F.split("t", " ")).alias("w")).distinct().select("w", F.xxhash64("w").alias("h")).collect()}
    whole, part = (r[0] for r in frame.select(syncmers.anchors(F.col("t"))).collect())
    pairs = spark.createDataFrame([(i, h[a], h[b]) for i, (a, b) in enumerate(zip(words, words[1:]))], "i int, a long, b long")
    inner = [r[0] for r in pairs.orderBy("i").select(F.xxhash64("a", "b")).collect()]
    span = syncmers.K - syncmers.S + 1
    expected = [i for i in range(len(words) - syncmers.K + 1) if min(inner[i:i + span]) in (inner[i], inner[i + span - 1])]
    assert [a.pos for a in whole] == expected
    inside = {a.hash for a in whole if 40 <= a.pos <= 90 - syncmers.K}
    assert inside <= {a.hash for a in part}
    found = frame.select(syncmers.anchors(F.col("t")).alias("x")).agg(F.first("x").alias("x"), F.last("x").alias("y"))
    moved = found.select(syncmers.aligned(F.col("x"), F.col("y")).alias("m")).first().m
    assert {m.pos - m.other for m in moved} >= {38}


def test_licenses_against_every_run_of_words(docs):
    rng = random.Random(3)
    notices = [n for _, n in licenses.TEMPLATES]
    rows = [(i, " ".join(rng.choice(["the", "a", "license", "under", "of", "Foo,"]) for _ in range(rng.randrange(0, 60)))) for i in range(30)]
    for i, n in enumerate(notices):
        rows.append((100 + i, rows[i][1] + " " + n + " " + rows[i + 5][1]))
        w = n.split()
        if len(w) > 11:
            rows.append((200 + i, rows[i][1] + " " + " ".join(w[:5] + ["zzz"] + w[6:]) + " tail"))
    rows += [(400, None), (401, ""), (402, notices[2].upper())]

    def words(t):
        out, now = [], ""
        for c in (t or "") + " ":
            c = c.lower() if "A" <= c <= "Z" else c
            if c.isascii() and c.isalnum():
                now += c
            elif now:
                out.append(now)
                now = ""
        return out
    expected = {}
    for i, t in rows:
        own = words(t)
        pairs = list(zip(own, own[1:])) or [tuple(own)] * bool(own)
        for k, n in enumerate(notices):
            w = words(n)
            want = set(zip(w, w[1:]))
            span = -(-len(w) * 5 // 4) - 1
            best = max((len(want & set(pairs[s:s + span])) / len(want) for s in range(len(pairs))), default=0)
            if best >= 0.8:
                expected[i, k] = best
    got = {(r.doc_id, r.template): r.containment for r in licenses.license_scan(docs(rows)).collect()}
    assert got == pytest.approx(expected)
    assert licenses.license_scan(docs([(1, "no notice"), (2, None)])).count() == 0
    assert licenses.license_scan(docs([])).count() == 0


PAGES = {
    "furniture": ("<html><body><nav><ul><li><a href=/>Home</a></ul></nav><div class='ad-box'>Buy, now, cheap, things</div><header>Site</header>"
                  "<article><h1>Title &amp; more</h1><p><b>First,\n  block<br>here<p>Second&nbsp;block <a href=x>link</a>.</p>"
                  "<aside>See also</aside><form>Mail <input></form><script>var a='</p>';</script><div id=comments><p>Nice, nice, post</p></div></article>"
                  "<div class='cookie notice'>We, use, cookies</div><footer>(c)</footer>",
                  "Title & more\nFirst, block here\nSecond block link."),
    "scores": ("<body><div><a href=1>One</a> <a href=2>Two, three, four</a></div><div><div><p>" + "Long text, with commas, and words. " * 5
               + "</p><p>Short one.</p></div></div>", ("Long text, with commas, and words. " * 5).strip() + "\nShort one."),
    "plain": ("just text < 3", "just text < 3"),
    "nothing": ("<html><script>x</script><nav>Menu</nav>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text_of_page(name):
    page, text = PAGES[name]
    assert main_text.extract(page) == text


BODY = "<p>Long text, with commas, and words, which go on for more than a line of it.</p>" * 2
LINES = "\n".join(["Long text, with commas, and words, which go on for more than a line of it."] * 2)


@pytest.mark.parametrize("page, text", [
    (f"<div class='overflow-hidden'><article>{BODY}</article></div>", LINES),
    (f"<div class=has-sidebar><article>{BODY}</article><div class=sidebar>More</div></div>", LINES),
    (f"<div class=widget><article>{BODY}</article></div>", LINES),
    (f"<form id=f><main>{BODY}</main></form>", LINES),
    (f"<div class=related><article><p>Card</p></article></div><article>{BODY}</article>", LINES),
    (f"<div class=notice><div>{BODY}</div></div><div class=menu><a href=1>One</a></div>", LINES),
    (f"<article>{BODY}<h2 id=related-work>Related work</h2><h2 class=notice>Note</h2></article>", LINES + "\nRelated work\nNote"),
    (f"<article>{BODY}<section id=discussion><p>We saw.</p></section></article>", LINES + "\nWe saw."),
    (f"<article>{BODY}<p title='the hidden cost'>Cost <a href='/hidden/x'>here</a>, it is low.</p></article>", LINES + "\nCost here, it is low."),
    (f"<article>{BODY}<p data-hidden=1>Shown</p><p hidden>Not</p><div class='ad-box-2'>Buy</div></article>", LINES + "\nShown"),
    (f"<body><h1>Title</h1><div>{BODY}</div><p>Short end.</p></body>", "Title\n" + LINES + "\nShort end."),
])
def test_main_text_keeps_what_only_sounds_like_furniture(page, text):
    assert main_text.extract(page) == text


CHAT = "<p>I, for one, think, as ever, that this, all of it, is, well, what it is, and more.</p>" * 9


@pytest.mark.parametrize("page, text", [
    (f"<article>{BODY}</article><div id='user-comments'>{CHAT}</div>", LINES),
    (f"<article>{BODY}</article><div class='cookie-consent-text'>{CHAT}</div>", LINES),
    (f"<article>{BODY}</article><div class=unheard-of>{CHAT}</div>", LINES),
    (f"<main><div>{BODY}</div></main><div class=unheard-of>{CHAT}</div>", LINES),
    (f"<article>{BODY}<div class='comment-body'>{CHAT}</div><div id=user-comments><p>Hm.</p></div>"
     f"<section class=article-comments>{CHAT}</section></article>", LINES),
    (f"<article>{BODY}<section class=comment-on-rates><p>Rates rose.</p></section></article>", LINES + "\nRates rose."),
    (f"<div><p>x <a href=1>a</a></p></div><div>{CHAT}</div><article><a href=2>Read on</a></article>",
     "\n".join([CHAT[3:].split("</p>")[0]] * 9)),
    (f"<article>{BODY}<p><a href=/it's>link</a></p><p>I don't know > that</p></article>", LINES + "\nlink\nI don't know > that"),
    (f'<article>{BODY}<p title="abc>Open</p></article>', LINES + "\nOpen"),
    (f"<article>{BODY}<p a = 'x>y' b=\"'>\" c>Closed</p></article>", LINES + "\nClosed"),
    (f"<article>{BODY}<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p></article>", LINES + "\nLet x=2 hold."),
    (f"<article>{BODY}<blockquote><p>So it is.</p><footer>A reader</footer></blockquote><footer>(c)</footer></article>",
     LINES + "\nSo it is.\nA reader"),
])
def test_main_text_isnt_lost_to_its_surroundings(page, text):
    assert main_text.extract(page) == text


@pytest.mark.parametrize("open_tag", ["<div>", "<div><p>", "<ul><li>", "<b>", "<span></i>", "<div></x>", "<p a='", "<p a=b"])
def test_main_text_takes_linear_time(open_tag):
    start = time.process_time()
    main_text.extract(open_tag * 30_000 + "<p>Deep, text</p>")
    assert time.process_time() - start < 5


def test_main_text_of_deep_pages():
    assert main_text.extract("<div>" * 100_000 + "<p>Deep, text</p>") == "Deep, text"


def test_pages_null_empty_repeated_and_long(spark):
    long = "<article>" + "<p>word, word</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", PAGES["plain"][0]), (3, "u", PAGES["plain"][0]), (None, "u", long), (5, "u", "<div>" * 3000 + "deep")]
    got = main_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(9))).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 20_000 * 11 - 1), (1, 0), (2, 0), (3, 13), (3, 13), (5, 4)]
    assert main_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_encoding_equals_the_library(docs):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(VOCABULARY)
    rng = random.Random(4)
    parts = [*"ab '\n\t.,!?séñ中1٣\u0085\x1c​😀", "  ", "   ", "'s", "'ll", " the", "<|endoftext|>", "\r\n", "word" * 30]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 40)))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "a" * 30_000), (903, " "), (904, "  "), (905, "x \n")]
    got = {r.doc_id: r for r in bpe.round_trip(docs(rows), VOCABULARY).collect()}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert tuple(got[i])[1:] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_encoding_and_decoding_columns(docs):
    rows = [(1, "Some text, twice."), (2, None), (2, "É 中"), (None, "x")]
    back = bpe.decoded(bpe.encoded(docs(rows), VOCABULARY).drop("text"), VOCABULARY).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t in rows)
    assert bpe.encoded(docs([]), VOCABULARY).count() == 0


def test_cuts_fall_only_where_no_token_has_the_pair():
    codec = bpe.Codec(open(VOCABULARY, encoding="utf-8").read())
    pairs = {t[i:i + 2] for t in codec.bytes_of.values() if t != b"<|endoftext|>" for i in range(len(t) - 1)}
    for piece in (" thequickbrown中文".encode(), b"zzzzqqqqxjxj", "éàüß".encode()):
        fragments = codec.cuts(piece)
        assert b"".join(fragments) == piece
        assert all(a[-1:] + b[:1] not in pairs for a, b in zip(fragments, fragments[1:]))
        assert all(f[i:i + 2] in pairs for f in fragments for i in range(len(f) - 1))
