"""Repeated passages: every byte covered by a string of 100 bytes that also starts earlier is found and removed.

A text collection's suffixes are sorted column by column: each round inserts
one symbol per piece, so the order of all pieces' suffixes (the collection's
Burrows-Wheeler transform of that column) and the common prefixes of
neighbours are updated from the round before. To do that in parallel, texts
are cut into short overlapping pieces around anchors (the smallest hash among
a window's substrings of 32 bytes). Equal windows have equal anchors at equal
places, so pieces are sorted apart for each anchor, aligned on it, and only
suffixes that start in the same column can match. There are 137 rounds,
however long the texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heatmart.llm.common import U64, Rolling, byte_chunks, stored

LENGTH = 100
ANCHOR = 32
# Windows start at most this many bytes before their anchor.
REACH = LENGTH - ANCHOR
# Anchors with more different pieces are compared window by window, by hash and grouping.
CROWD = 32_768
# Bytes of a text that are hashed at a time; longer texts are worked on in such segments.
SEGMENT = 1 << 20
# Pieces that a task sorts at a time.
SORTED = 20_000

_ROLL = Rolling(31)
_PLACE = U64((1 << 24) - 1)


def _anchored(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: first window, number, anchor's place, its hash, hash of all their bytes.

    ``ends`` has the end of each text in data; a window lies in one text.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 2
    total = _ROLL.sums(data)
    h = _ROLL.windows(total, ANCHOR)
    low = (h & ~_PLACE) | np.arange(len(h), dtype=U64)
    span, width = 1, REACH + 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:span - width], low[width - span:])
    inside = np.zeros(len(data) + 1, np.int8)
    starts = np.concatenate([[0], ends[:-1]])
    has = ends - starts >= LENGTH
    np.add.at(inside, starts[has], 1)
    np.add.at(inside, ends[has] - LENGTH + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:n], dtype=np.int8))
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 2
    anchor = (low[at] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(at) != 1)]))
    first = at[new]
    count = np.diff(np.append(new, len(at)))
    anchor = anchor[new]
    return first, count, anchor, h[anchor], _ROLL.ranges(total, first, first + count + LENGTH - 1)


def _segments(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, end of each text in them, row of each text, where its bytes start in the row)."""
    for first, end, data, offsets in byte_chunks(column, SEGMENT):
        if len(data) <= SEGMENT:
            yield data, offsets[1:], np.arange(first, end), np.zeros(end - first, np.int64)
            continue
        for at in range(0, max(len(data) - LENGTH + 1, 1), SEGMENT):
            part = data[at:at + SEGMENT + LENGTH - 1]
            yield part, np.array([len(part)]), np.array([first]), np.array([at])


def _anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchor's hash of each run, nothing else, for counting."""
    for batch in batches:
        for data, ends, *_ in _segments(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(_anchored(data, ends)[3].view(np.int64))], ["h"])


RUN = "h long, ph long, id long, th long, pos long, n int, off int"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run of windows with one anchor: hashes of the anchor and of all bytes, text, first window, number, anchor's offset."""
    for batch in batches:
        ids, ths = batch.column(0), batch.column(1)
        for data, ends, rows, base in _segments(batch.column(2)):
            first, count, anchor, h, ph = _anchored(data, ends)
            text = np.searchsorted(ends, first, "right")
            row = pa.array(rows[text])
            pos = first - np.concatenate([[0], ends[:-1]])[text] + base[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(ph.view(np.int64)), ids.take(row), ths.take(row), pa.array(pos),
                 pa.array(count.astype(np.int32)), pa.array((anchor - first).astype(np.int32))],
                ["h", "ph", "id", "th", "pos", "n", "off"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted runs; those of crowded anchors as one hash per window."""
    for batch in batches:
        out: list[tuple] = []
        size = 0
        for id_, th, text, wanted in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), batch.column(3)):
            data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            for want in wanted.as_py():
                pos, n = want["pos"], want["n"]
                own = data[pos:pos + n + LENGTH - 1]
                if want["crowd"]:
                    at = np.arange(n)
                    w = _ROLL.ranges(_ROLL.sums(own), at, at + LENGTH).view(np.int64)
                    out.append((want["h"], id_, th, pos, n, want["off"], None, w))
                else:
                    out.append((want["h"], id_, th, pos, n, want["off"], own.tobytes(), None))
                size += 1
            if size >= 4096:
                yield _piece_batch(out)
                out, size = [], 0
        if out:
            yield _piece_batch(out)


PIECE = "h long, id long, th long, pos long, n int, off int, bytes binary, windows array<long>"
_PIECE = [("h", pa.int64()), ("id", pa.int64()), ("th", pa.int64()), ("pos", pa.int64()), ("n", pa.int32()),
          ("off", pa.int32()), ("bytes", pa.binary()), ("windows", pa.list_(pa.int64()))]


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_PIECE)], [n for n, _ in _PIECE])


def _sorted_by_column(h: np.ndarray, rank: np.ndarray, off: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which windows of which pieces also start earlier; a row per piece, a column per start before the anchor.

    Pieces must come anchor by anchor. Round by round, from the last column to
    the first, one symbol of each piece goes in front of its suffix: ``order``
    has the suffixes of each anchor sorted, ``common`` the length of the prefix
    that each shares with the one before it.
    """
    m = len(texts)
    size = np.fromiter(map(len, texts), np.int64, m)
    column = np.full((m, REACH + LENGTH), 256, np.int16)
    at = np.repeat(REACH - off - np.cumsum(size) + size, size) + np.arange(size.sum())
    column[np.repeat(np.arange(m), size), at] = np.frombuffer(b"".join(texts), np.uint8)
    same = np.concatenate([[False], h[1:] == h[:-1]])
    group = np.cumsum(~same)
    order, common = np.arange(m), np.zeros(m + 1, np.int64)
    earlier = np.zeros((m, REACH + 1), bool)
    for c in range(REACH + LENGTH - 1, -1, -1):
        if REACH <= c < LENGTH:
            # The anchor itself: all pieces of a group have the same symbol.
            common[:-1][same] += 1
        else:
            key = group[order] * 257 + column[order, c]
            new = np.argsort(key, kind="stable")
            here, before = new[1:], new[:-1]
            alike = (key[here] == key[before]) & (column[order[here], c] != 256)
            shared = np.zeros(m + 1, np.int64)
            u, v = before[alike], here[alike]
            low = common[v]
            far = np.flatnonzero(v != u + 1)
            if len(far):
                low[far] = np.minimum.reduceat(common, np.c_[u[far] + 1, v[far] + 1].ravel())[::2]
            shared[1:m][alike] = low + 1
            order, common = order[new], shared
        if c <= REACH:
            starts = np.flatnonzero(common[:-1] < LENGTH)
            if len(starts) < m:
                least = np.minimum.reduceat(rank[order], starts)
                earlier[order, c] = rank[order] > np.repeat(least, np.diff(np.append(starts, m)))
    return earlier


MARK = "id long, th long, start long, n long"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of windows that also start earlier, from pieces sorted by anchor.

    Only whole anchors are sorted together; at most SORTED pieces and one
    anchor (CROWD pieces) are in memory.
    """
    waiting: list[pa.RecordBatch] = []

    def done(rows: pa.Table) -> pa.RecordBatch:
        h, id_, th, pos, off = (rows.column(c).to_numpy() for c in ("h", "id", "th", "pos", "off"))
        rank = np.empty(len(h), np.int64)
        rank[np.lexsort((pos + off, th, id_))] = np.arange(len(h))
        earlier = _sorted_by_column(h, rank, off, rows.column("bytes").to_pylist())
        edge = np.diff(np.pad(earlier, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        piece, start = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        return pa.RecordBatch.from_arrays(
            [pa.array(id_[piece]), pa.array(th[piece]), pa.array(pos[piece] + start - REACH + off[piece]), pa.array((end - start).astype(np.int64))],
            ["id", "th", "start", "n"])

    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= SORTED:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            h = rows.column("h").to_numpy()
            whole = int(np.flatnonzero(h != h[-1])[-1]) + 1 if (h != h[-1]).any() else 0
            if whole:
                yield done(rows.slice(0, whole))
            waiting = rows.slice(whole).to_batches()
    if sum(b.num_rows for b in waiting):
        yield done(pa.Table.from_batches(waiting).combine_chunks())


RESULT = ["n_bytes", "n_removed", "n_spans", "kept", "spans"]


def _texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, th, text): th tells texts of one id apart, and is 0 as long as ids don't repeat."""
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63))
    text = F.col(text_col).cast("string")
    rows = docs.select(id_.alias("id"), text.alias("text"), *more)
    again = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    th = F.xxhash64(F.coalesce("text", F.lit(""))) if again else F.lit(0).cast("long")
    return rows.select("id", th.alias("th"), "text", *["row"] * bool(more))


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(id, th, start, n): ranges of starts of windows that also occur earlier, of (id, th, text).

    Anchors that occur once are left behind by counting them. Runs of windows
    with equal bytes are grouped, and all but the earliest are marked. What
    differs but shares an anchor is fetched as bytes and sorted column by
    column; crowded anchors are taken apart into windows instead, which are
    grouped by hash, so no anchor fills a task. Counts are written before they
    are joined back: beside a table, unlike beside an aggregate of the same
    stage, Spark splits an anchor that many rows share.
    """
    runs = texts.mapInArrow(_runs, RUN)
    again, _ = stored(texts.select("text").mapInArrow(_anchor_hashes, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"))
    hits, _ = stored(runs.join(again, "h", "left_semi"))
    first = F.min(F.struct("id", "th", "pos", "n", "off")).alias("first")
    kinds, _ = stored(hits.groupBy("h", "ph").agg(first))
    copies = (hits.join(kinds, ["h", "ph"]).where("id <> first.id or th <> first.th or pos <> first.pos")
              .select("id", "th", F.col("pos").alias("start"), F.col("n").cast("long")))
    mixed, at = stored(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), most=F.max("m"))
    wanted = (kinds.join(mixed, "h").groupBy("first.id", "first.th").agg(
        F.collect_list(F.struct("h", "first.pos", "first.n", "first.off", (F.col("m") > CROWD).alias("crowd"))).alias("wanted")))
    # Not stored: its shuffle of the texts is the one that the removal uses.
    pieces = texts.join(wanted, ["id", "th"]).select("id", "th", "text", "wanted").mapInArrow(_pieces, PIECE)
    judged = (pieces.where("bytes is not null").drop("windows").repartition("h").sortWithinPartitions("h")
              .mapInArrow(_judged, MARK))
    if (at["most"] or 0) <= CROWD:
        return copies.union(judged)
    windows = pieces.where("windows is not null").select("h", "id", "th", "pos", F.posexplode("windows").alias("i", "w")).select(
        "h", "w", "id", "th", (F.col("pos") + F.col("i")).alias("start"))
    earliest, _ = stored(windows.groupBy("h", "w").agg(
        F.min(F.struct("id", "th", "start")).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1"))
    crowded = (windows.join(earliest, ["h", "w"]).where("id <> first.id or th <> first.th or start <> first.start")
               .select("id", "th", "start", F.lit(1).cast("long").alias("n")))
    return copies.union(judged).union(crowded)


def _spans(text: bytes, marks: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal removed runs."""
    covered = np.zeros(len(text) + 1, np.int64)
    start = np.array([m["start"] for m in marks], np.int64)
    end = start + np.array([m["n"] for m in marks], np.int64) + LENGTH - 1
    np.add.at(covered, start, 1)
    np.add.at(covered, end, -1)
    edge = np.diff(np.concatenate([[0], np.cumsum(covered) > 0]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_columns: bool = False,
                    as_text: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept (binary: the remaining bytes), spans.

    A string of 100 bytes (LENGTH) is judged on the input: it is removed where
    the same bytes start in a text with a smaller id, or earlier in the same
    text. NULL counts as empty; texts under 100 bytes stay whole. A NULL id
    comes before all others. Rows that share an id are told apart by their
    text, those with a smaller hash come first; rows equal in id and text are
    one document and get the same result. ``keep_columns`` puts the columns of
    docs first; those named like a result are replaced. ``as_text`` gives kept
    as a string, without the characters that lost only some of their bytes.
    """
    texts = _texts(docs, id_col, text_col)
    marks = repeated_windows(texts).groupBy("id", "th").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    others = [c for c in docs.columns if c not in (id_col, *RESULT)] if keep_columns else []
    if others:
        texts = _texts(docs, id_col, text_col, F.struct(*[F.col(c) for c in others]).alias("row"))
    kind = dict(docs.dtypes)[id_col]
    own = F.when(F.col("id") != F.lit(-2 ** 63), F.col("id")).cast(kind).alias("id")
    whole = texts.join(marks, ["id", "th"], "left").select(own, "text", "marks", *["row"] * bool(others))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string() if as_text else pa.binary(), span]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                out: list[tuple] = []
                for text, found in zip(part.column(1), part.column(2)):
                    data = (text.as_py() or "").encode()
                    start, end = _spans(data, found.as_py()) if found.is_valid else (np.zeros(0, np.int64),) * 2
                    edges = [0, *np.c_[start, end].ravel().tolist(), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    removed = len(data) - len(kept)
                    out.append((len(data), removed, len(start), kept.decode("utf-8", "ignore") if as_text else kept, [
                        {"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())]))
                made = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[3:], *made], names)

    names = ["id", *["row"] * bool(others), *RESULT]
    schema = f"id {kind}, " + (f"row {dict(texts.dtypes)['row']}, " if others else "") + (
        f"n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}, spans array<struct<start: long, end: long>>")
    return whole.mapInArrow(run, schema).select(
        F.col("id").alias(id_col), *[F.col("row")[c].alias(c) for c in others], *RESULT)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """without_repeats() with the digest of the remaining bytes in place of the bytes and spans."""
    return without_repeats(docs, id_col, text_col).select(
        id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
