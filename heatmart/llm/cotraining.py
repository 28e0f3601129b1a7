"""Quality by co-training: one model reads the text, one the metadata, and they teach each other."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heatmart.llm.common import byte_chunks, word_hashes, words

# Most labelled and most unlabelled rows that training looks at, by hash of the id.
LABELLED = 12_000
UNLABELLED = 12_000
ROUNDS = 3
# A view passes on a label only when its calibrated probability is this sure.
SURE = 0.97
# Most pseudo-labels of each class that a view gives in a round.
GIVEN = 1_000
HASHED = 256
# Most standard deviations from the mean that a feature counts.
FAR = 4.0
# Share of labelled good texts, held out from training, that must be kept.
KEEP = 0.999

_CLASS = np.zeros(256, np.int64)  # 0 control, 1 blank, 2 line end, 3 lower, 4 upper, 5 digit, 6.. punctuation, 15 high
_CLASS[32] = 1
_CLASS[10] = 2
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 3, 4, 5, 15
for _i, _set in enumerate((b".,;:", b"!?", b"'\"`", b"()[]{}<>", b"#$%&*@^~", b"|\\/", b"-_=+")):
    _CLASS[list(_set)] = 6 + _i
KINDS = 16
STATS = 2 * KINDS + 6


def text_features(column: pa.Array) -> np.ndarray:
    """One row of features per text: byte classes, words, classes at word ends, hashed words.

    NULL and empty texts give zeros.
    """
    out = np.zeros((len(column), STATS + HASHED), np.float32)
    for first, end, data, offsets in byte_chunks(column):
        n = end - first
        size = np.diff(offsets)
        kind = _CLASS[data]
        doc = np.repeat(np.arange(n), size)
        kinds = np.bincount(doc * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS)
        starts, ends, at = words(data, offsets)
        count = np.diff(at)
        word_doc = np.repeat(np.arange(n), count)
        last = np.bincount(word_doc * KINDS + kind[ends - 1], minlength=n * KINDS).reshape(n, KINDS) if len(ends) else np.zeros((n, KINDS))
        hashes, _ = word_hashes(data, offsets)
        bag = np.bincount(word_doc * HASHED + (hashes & np.uint64(HASHED - 1)).astype(np.int64), minlength=n * HASHED).reshape(n, HASHED)
        per_byte, per_word = 1 / np.maximum(size, 1)[:, None], 1 / np.maximum(count, 1)[:, None]
        rows = out[first:end]
        rows[:, :KINDS] = np.sqrt(kinds * per_byte)
        rows[:, KINDS:2 * KINDS] = np.sqrt(last * per_word)
        length = (ends - starts).astype(np.float64)
        mean = np.bincount(word_doc, length, n) / np.maximum(count, 1)
        rows[:, 2 * KINDS] = np.log1p(count) / 10
        rows[:, 2 * KINDS + 1] = mean / 10
        rows[:, 2 * KINDS + 2] = np.sqrt(np.bincount(word_doc, (length - mean[word_doc]) ** 2, n) / np.maximum(count, 1)) / 10
        rows[:, 2 * KINDS + 3] = (bag > 0).sum(1) / np.minimum(np.maximum(count, 1), HASHED)
        rows[:, 2 * KINDS + 4] = np.log1p(kinds[:, 2]) / 5
        rows[:, 2 * KINDS + 5] = bag.max(1) / np.maximum(count, 1)
        rows[:, STATS:] = np.sqrt(bag * per_word)
    return out


def meta_features(source: pa.Array, lang: pa.Array, chars: pa.Array) -> np.ndarray:
    """One row of features per document: hashed source and language, and the length by its logarithm."""
    n = len(source)
    out = np.zeros((n, 64 + 16 + 18), np.float32)
    for column, at, width in ((source, 0, 64), (lang, 64, 16)):
        for first, end, data, offsets in byte_chunks(column):
            hashes, where = word_hashes(data, offsets)
            has = np.flatnonzero(np.diff(where))
            out[first + has, at + (hashes[where[:-1][has]] % np.uint64(width)).astype(np.int64)] = 1
    length = np.nan_to_num(chars.cast(pa.float64()).to_numpy(zero_copy_only=False))
    log = np.log2(1 + np.maximum(length, 0))
    out[np.arange(n), 80 + np.minimum(log.astype(np.int64), 16)] = 1
    out[:, 97] = log / 20
    return out


@dataclass
class Logistic:
    """Logistic regression on standardized features, and the scale found on held-out rows."""

    ridge: float = 1.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: float = 1.0
    shift: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Logistic":
        self.centre, self.spread = x.mean(0), x.std(0) + 1e-3
        z = np.c_[self.scaled(x), np.ones(len(x))].astype(np.float64)
        w = np.zeros(z.shape[1])
        penalty = np.full(len(w), self.ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            p = _sigmoid(z @ w)
            grad = z.T @ (p - y) + penalty * w
            h = (z * np.maximum(p * (1 - p), 1e-5)[:, None]).T @ z
            h[np.diag_indices_from(h)] += penalty
            step = np.linalg.solve(h, grad)
            w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-4:
                break
        self.weights = w
        return self

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """Standardized; far beyond what training saw, features weigh no more."""
        return np.clip((x - self.centre) / self.spread, -FAR, FAR)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x) @ self.weights[:-1] + self.weights[-1]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> "Logistic":
        line = Logistic(ridge=1e-2).fit(self.raw(x)[:, None], y)
        self.slope = float(line.weights[0] / line.spread[0])
        self.shift = float(line.weights[1] - line.weights[0] * line.centre[0] / line.spread[0])
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.raw(x) * self.slope + self.shift, -30, 30)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Quality:
    """Both views, how they combine, and the score below which a document is rejected."""

    text: Logistic | None
    meta: Logistic | None
    joint: Logistic | None
    limit: float
    rounds: list[tuple[int, int]]
    prior: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.text is None:
            same = np.full(len(text), self.prior)
            return same, same, same
        a, b = self.text.logit(text), self.meta.logit(meta)
        return _sigmoid(a), _sigmoid(b), _sigmoid(self.joint.logit(np.c_[a, b]))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, more_text: np.ndarray, more_meta: np.ndarray,
             rounds: int = ROUNDS) -> Quality:
    """Fit both views on labelled rows; in each round, each labels what it is sure of for the other.

    Every fourth labelled row is held out: it calibrates the views, weighs
    them against each other and sets the limit. With one class only, or fewer
    than 20 rows, nothing is learned and nothing rejected.
    """
    held = np.arange(len(y)) % 4 == 3
    if len(y) < 20 or min(y[held].sum(), (1 - y[held]).sum(), y[~held].sum(), (1 - y[~held]).sum()) == 0:
        return Quality(None, None, None, 0.0, [], float(y.mean()) if len(y) else 1.0)
    extra: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * 2
    views, given = [], []
    for r in range(rounds + 1):
        views = []
        for own, more, (rows, labels) in ((text, more_text, extra[0]), (meta, more_meta, extra[1])):
            model = Logistic().fit(np.r_[own[~held], more[rows]], np.r_[y[~held], labels])
            views.append(model.calibrate(own[held], y[held]))
        if r == rounds or not len(more_text):
            break
        sure = [_sigmoid(v.logit(m)) for v, m in zip(views, (more_text, more_meta))]
        taught = []
        for p in sure:
            good = np.flatnonzero(p >= SURE)
            bad = np.flatnonzero(p <= 1 - SURE)
            good = good[np.argsort(-p[good], kind="stable")][:GIVEN]
            bad = bad[np.argsort(p[bad], kind="stable")][:GIVEN]
            taught.append((np.r_[good, bad], np.r_[np.ones(len(good)), np.zeros(len(bad))]))
        extra = [taught[1], taught[0]]  # each learns from the other
        given.append((len(taught[0][0]), len(taught[1][0])))
    both = np.c_[views[0].logit(text[held]), views[1].logit(meta[held])]
    joint = Logistic().fit(both, y[held])
    p = _sigmoid(joint.logit(both))
    limit = min(0.5, float(np.quantile(p[y[held] == 1], 1 - KEEP)))
    return Quality(views[0], views[1], joint, limit, given, float(y.mean()))


def _view(docs: DataFrame) -> list[Column]:
    """The columns the views read; missing metadata is empty."""
    def of(name: str, kind: str, other: Column) -> Column:
        return (F.col(name).cast(kind) if name in docs.columns else other).alias(f"__{name}")
    return [of("text", "string", F.lit("")), of("source", "string", F.lit("")), of("lang", "string", F.lit("")),
            of("n_chars", "long", F.lit(0).cast("long"))]


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_features(batch.column("__text")), meta_features(
        batch.column("__source"), batch.column("__lang"), batch.column("__n_chars"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          labelled: int = LABELLED, unlabelled: int = UNLABELLED, rounds: int = ROUNDS) -> Quality:
    """Fit on at most ``labelled`` labelled and ``unlabelled`` other documents.

    Both samples are the smallest hashes of ids, so they don't depend on the
    layout of the data. An id with contradicting labels, or a NULL label,
    counts as unlabelled.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("__id"))
             .agg(F.min(label_col).alias("lo"), F.max(label_col).alias("hi")).where("lo = hi").select("__id", F.col("lo").alias("label")))
    pick = F.xxhash64("__id", F.lit(7))
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id")).distinct().join(known, "__id", "left")
    chosen = [ids.where(c).orderBy(pick, "__id").limit(n)
              for c, n in (("label is not null", labelled), ("label is null", unlabelled))]
    rows = docs.select(F.col(id_col).alias("__id"), *_view(docs)).join(chosen[0].union(chosen[1]), "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                text, meta = _features(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), part.column("label"), pa.array([r.tobytes() for r in text.astype(np.float16)], pa.binary()),
                     pa.array([r.tobytes() for r in meta.astype(np.float16)], pa.binary())], ["id", "label", "text", "meta"])

    kinds = dict(rows.dtypes)
    got = rows.mapInArrow(run, f"id {kinds['__id']}, label {kinds['label']}, text binary, meta binary").orderBy(
        F.xxhash64("id", F.lit(7)), "id", F.xxhash64("text")).toArrow()
    width = [STATS + HASHED, 98]
    arrays = [np.frombuffer(b"".join(got.column(c).to_pylist()), np.float16).reshape(-1, w).astype(np.float32)
              for c, w in zip(("text", "meta"), width)]
    y = got.column("label").to_pylist()
    is_known = np.array([v is not None for v in y], bool)
    return co_train(arrays[0][is_known], arrays[1][is_known], np.array([v for v in y if v is not None], np.float64),
                    arrays[0][~is_known], arrays[1][~is_known], rounds)


def scored(docs: DataFrame, model: Quality) -> DataFrame:
    """docs plus p_text, p_meta, score (probability of good quality) and keep.

    Every row gets a score from its whole text. A document is rejected when
    its score is below the model's limit. Earlier columns of those names are
    replaced. Texts that are NULL or empty are scored on zero features.
    """
    new = ["p_text", "p_meta", "score", "keep"]
    docs = docs.drop(*new)
    names = docs.columns
    wide = docs.select("*", *_view(docs))
    view = wide.columns[len(names):]
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", p_text double, p_meta double, score double, keep boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                own = pa.RecordBatch.from_arrays(part.columns[len(names):], view)
                p = model.scores(*_features(own))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(names)], *(pa.array(x.astype(np.float64)) for x in p), pa.array(p[2] >= model.limit)], [*names, *new])

    return wide.mapInArrow(run, schema)
