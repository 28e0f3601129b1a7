"""Byte-level BPE at scale: words are cut at byte pairs that no token holds, fragments encoded alone."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

# Splitting rule of the vocabulary's tokenizer, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANKS = re.compile(r"\s \s|\s \Z")
# Remembered words per task; beyond it the memory starts anew.
REMEMBERED = 500_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable ones for themselves, then from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file.

    A text falls into pieces (matches of PATTERN), and each piece is cut
    wherever two neighbouring bytes occur side by side in no token: no merge
    can ever cross such a cut, so the fragments are encoded independently and
    concatenated. A letter followed by a blank is such a pair too, which
    allows whole texts to be cut into words before anything else.
    """

    def __init__(self, file: str) -> None:
        tokenizer = Tokenizer.from_str(file)
        letters = byte_letters()
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        vocab = {t: i for t, i in tokenizer.get_vocab(with_added_tokens=True).items() if t not in self.special}
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        inside = bytearray(65536)
        for token in self.bytes_of.values():
            for a, b in zip(token, token[1:]):
                inside[a << 8 | b] = 1
        self.inside = bytes(inside)
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.letters = {b: c for c, b in letters.items()}
        self.model = tokenizer.model
        self.pieces = regex.compile(PATTERN).findall
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.fragment = _Memory(self._fragment)
        self.word = _Memory(lambda word: self._pieces(" " + word))

    def cuts(self, piece: bytes) -> list[bytes]:
        """The fragments between forced boundaries."""
        out, start, inside = [], 0, self.inside
        for i in range(1, len(piece)):
            if not inside[piece[i - 1] << 8 | piece[i]]:
                out.append(piece[start:i])
                start = i
        out.append(piece[start:])
        return out

    def _fragment(self, fragment: bytes) -> bytes:
        tokens = self.model.tokenize(fragment.decode("latin-1").translate(self.letters))
        return b"".join([t.id.to_bytes(4, "little") for t in tokens])

    def _pieces(self, text: str) -> bytes:
        fragment, cuts = self.fragment, self.cuts
        return b"".join([fragment[f] for piece in self.pieces(text) for f in cuts(piece.encode())])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if self.special_at and self.special_at.search(text):
            return b"".join([self.special[part].to_bytes(4, "little") if part in self.special else self._words(part)
                             for part in self.special_at.split(text)])
        return self._words(text)

    def _words(self, text: str) -> bytes:
        # A blank between two other blanks, or the last of several at the end,
        # belongs to a longer piece: such texts are not cut before blanks.
        if BLANKS.search(text):
            return self._pieces(text)
        first, *rest = text.split(" ")
        return self._pieces(first) + b"".join(map(self.word.__getitem__, rest))

    def decode(self, ids: bytes) -> str:
        values = memoryview(ids).cast("I").tolist()
        return b"".join(map(self.bytes_of.__getitem__, values)).decode("utf-8", "replace")


class _Memory(dict):
    """Results by key; forgets all beyond REMEMBERED, and keeps no long keys."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


def encoded(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs plus ``ids``: array<int> of token ids of the whole text; NULL counts as empty."""
    return _mapped(docs, tokenizer, text_col, [(ids_col, "array<int>")], lambda codec, ids: [
        memoryview(ids).cast("I").tolist()])


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each whole text; NULL counts as empty."""
    def digests(codec: Codec, ids: bytes) -> list:
        return [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest()]

    return _mapped(docs.select(id_col, text_col), tokenizer, text_col, [
        ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], digests).drop(text_col)


def decoded(docs: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """docs plus ``text`` decoded from ``ids``; NULL counts as no ids."""
    with open(tokenizer, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.drop(text_col).dtypes) + f", `{text_col}` string"
    names = docs.drop(text_col).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(file.value)
        for batch in batches:
            texts = [b"".join(codec.bytes_of[i] for i in ids or ()).decode("utf-8", "replace")
                     for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], [*names, text_col])

    return docs.mapInArrow(run, schema)


def _mapped(docs: DataFrame, tokenizer: str, text_col: str, new: list[tuple[str, str]], make) -> DataFrame:
    """docs with columns made from each text's ids; earlier columns of those names are replaced.

    The vocabulary file (a few MB, whatever the data) is read by the driver
    and broadcast; rows are worked on where they are, without a shuffle.
    """
    docs = docs.drop(*[n for n, _ in new])
    with open(tokenizer, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    names = docs.columns
    schema = ", ".join(f"`{n}` {t}" for n, t in [*docs.dtypes, *new])
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(file.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rows = [make(codec, codec.encode(t.as_py() or "")) for t in part.column(names.index(text_col))]
                made = [pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(new)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*names, *(n for n, _ in new)])

    return docs.mapInArrow(run, schema)
