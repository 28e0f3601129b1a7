"""SQL counterparts of the queries that SQL can express, for an independent engine over the same tables."""

from __future__ import annotations

from heatmart.llm import licenses

SQL: dict[str, str] = {}

_GROUPS = """
reach(id, other) AS (
    SELECT {id}, {id} FROM {rows}
    UNION
    SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other),
groups AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

SQL["op1_embedding_dedup"] = f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
fit AS (
    SELECT * FROM vectors
    WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM fit x JOIN fit y
    ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
    WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
{_GROUPS.format(id="vec_id", rows="vectors")}
SELECT g.id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, component_id = g.id AS kept
FROM groups g LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = g.id"""

SQL["op2_minhash_dedup"] = f"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM tokens WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)),
{_GROUPS.format(id="doc_id", rows="documents")}
SELECT g.id AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = g.id AS kept
FROM groups g LEFT JOIN sizes s ON s.doc_id = g.id"""

# Texts are cut into blocks first, as taking a piece out of a long text reads all of it.
SQL["op4_suffix_dedup"] = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (
    SELECT doc_id, base, substr(h, 2 * base + 1, 2 * 599) AS part
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 500)) AS base FROM texts)),
strings AS (
    SELECT doc_id, base + i AS start, substr(part, 2 * i + 1, 200) AS s
    FROM (SELECT doc_id, base, part, unnest(range(0, least(500, length(part) // 2 - 99))) AS i FROM blocks)),
again AS (
    SELECT doc_id, start FROM (
        SELECT doc_id, start, row_number() OVER (PARTITION BY s ORDER BY doc_id, start) AS nth FROM strings)
    WHERE nth > 1),
marked AS (
    SELECT doc_id, start, coalesce(start - lag(start) OVER (PARTITION BY doc_id ORDER BY start) > 100, TRUE) AS first
    FROM again),
numbered AS (
    SELECT doc_id, start, sum(CAST(first AS INT)) OVER (PARTITION BY doc_id ORDER BY start) AS span FROM marked),
spans AS (
    SELECT doc_id, span, min(start) AS lo, max(start) + 100 AS hi FROM numbered GROUP BY doc_id, span),
gaps AS (
    SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS lo, lo AS hi FROM spans
    UNION ALL
    SELECT t.doc_id, coalesce(max(hi), 0), any_value(length(h)) // 2
    FROM texts t LEFT JOIN spans s ON s.doc_id = t.doc_id GROUP BY t.doc_id),
kept AS (
    SELECT g.doc_id, sha256(unhex(string_agg(substr(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo, hi))) AS digest
    FROM gaps g JOIN texts t ON t.doc_id = g.doc_id GROUP BY g.doc_id),
removed AS (SELECT doc_id, sum(hi - lo) AS bytes, count(*) AS n FROM spans GROUP BY doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(bytes, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, digest AS kept_sha256
FROM texts t JOIN kept k ON k.doc_id = t.doc_id LEFT JOIN removed r ON r.doc_id = t.doc_id"""


def _tokens(text: str) -> str:
    low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({low}, '[a-z0-9]+')"


_NOTICES = ", ".join("({}, '{}', '{}')".format(i, *[x.replace("'", "''") for x in t])
                     for i, t in enumerate(licenses.TEMPLATES))

SQL["op6_license_scan"] = f"""
WITH templates AS (
    SELECT id, license, {_tokens("notice")} AS w FROM (VALUES {_NOTICES}) v(id, license, notice)),
pieces AS (
    SELECT DISTINCT id, w[i] || ' ' || w[i + 1] AS s
    FROM (SELECT id, w, unnest(range(1, len(w))) AS i FROM templates)),
known AS (
    SELECT t.id, license, ceil(len(w) * 1.25) - 1 AS span, n
    FROM templates t JOIN (SELECT id, count(*) AS n FROM pieces GROUP BY id) p ON p.id = t.id),
tokens AS (SELECT doc_id, row_number() OVER () AS nr, {_tokens("text")} AS w FROM documents),
places AS (
    SELECT nr, doc_id, i, w[i] || ' ' || w[i + 1] AS s
    FROM (SELECT nr, doc_id, w, unnest(range(1, len(w))) AS i FROM tokens)),
hits AS (SELECT nr, doc_id, i, p.s, id FROM places p JOIN pieces q ON q.s = p.s),
held AS (
    SELECT x.nr, x.doc_id, x.id, x.i, count(DISTINCT y.s) / any_value(n) AS part
    FROM hits x JOIN known k ON k.id = x.id
    JOIN hits y ON y.nr = x.nr AND y.id = x.id AND y.i >= x.i AND y.i < x.i + span
    GROUP BY x.nr, x.doc_id, x.id, x.i)
SELECT doc_id, CAST(h.id AS BIGINT) AS template, license, max(part) AS containment,
       CAST(count(*) FILTER (WHERE part >= {licenses.CONTAINED}) AS BIGINT) AS n_places
FROM held h JOIN known k ON k.id = h.id
GROUP BY nr, doc_id, h.id, license HAVING max(part) >= {licenses.CONTAINED}"""

SQL["op11_hard_negatives"] = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS alike, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

_ITEM_WORDS = """regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

SQL["op12_decontamination"] = f"""
WITH items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS nr, doc_id, {_ITEM_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT nr, i, size, array_to_string(w[i:i + size - 1], ' ') AS s
    FROM (SELECT nr, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
hits AS (SELECT p.nr, p.i, p.size, item_id FROM places p JOIN windows v ON v.s = p.s AND v.size = p.size),
hit AS (SELECT nr, count(DISTINCT k) AS n FROM (SELECT nr, unnest(range(i, i + size)) AS k FROM hits) GROUP BY nr),
named AS (
    SELECT nr, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT nr, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY nr)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit h ON h.nr = d.nr LEFT JOIN named m ON m.nr = d.nr"""

# The checksum of a number's digits, bit by bit; a run of period q shows as a row of words equal to those q before.
SQL["op13_periodic_runs"] = """
WITH RECURSIVE digits AS (
    SELECT row_number() OVER () AS nr, doc_id, CAST(doc_id AS VARCHAR) AS d,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
checksum(nr, d, k, crc) AS (
    SELECT nr, d, 0, CAST(4294967295 AS BIGINT) FROM digits WHERE d IS NOT NULL
    UNION ALL
    SELECT nr, d, k + 1, CASE WHEN k % 9 = 0 THEN xor(crc, CAST(ascii(substr(d, CAST(k // 9 + 1 AS BIGINT), 1)) AS BIGINT))
                              WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END
    FROM checksum WHERE k < 9 * length(d)),
hashed AS (SELECT nr, xor(crc, 4294967295) AS h FROM checksum WHERE k = 9 * length(d)),
loops AS (
    SELECT d.nr, doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS looped, h // 10 AS g,
           CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a
    FROM digits d LEFT JOIN hashed ON hashed.nr = d.nr),
words AS (
    SELECT nr, i, CASE WHEN coalesce(looped, FALSE) AND i >= a THEN w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] ELSE w[i + 1] END AS word
    FROM (SELECT nr, w, n, looped, g, a, unnest(range(n)) AS i FROM loops)),
alike AS (
    SELECT x.nr, x.i, x.i - y.i AS q, x.i - row_number() OVER (PARTITION BY x.nr, x.i - y.i ORDER BY x.i) AS island
    FROM words x JOIN words y ON x.nr = y.nr AND x.word = y.word AND y.i < x.i
    JOIN loops l ON l.nr = x.nr AND 3 * (x.i - y.i) <= l.n),
stretches AS (
    SELECT nr, q, min(i) - q AS start, max(i) + 1 - min(i) + q AS length FROM alike GROUP BY nr, q, island),
runs AS (
    SELECT nr, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY nr, start, length),
best AS (
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY nr ORDER BY CAST(length AS HUGEINT) * 1000000000000 // period DESC, start, period) = 1),
listed AS (
    SELECT nr, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY nr),
dropped AS (SELECT DISTINCT nr, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT w.nr, string_agg(word, ' ' ORDER BY w.i) AS words
    FROM words w ANTI JOIN dropped d ON d.nr = w.nr AND d.i = w.i GROUP BY w.nr)
SELECT doc_id, CAST(coalesce(r.n, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM loops l LEFT JOIN listed r ON r.nr = l.nr LEFT JOIN best b ON b.nr = l.nr LEFT JOIN kept k ON k.nr = l.nr"""
