"""Quality classifier: weak labellers, expectation-maximisation, and a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the training sample (rows), width of the hashed weights, and words whose hash a worker remembers.
TRAIN_ROWS, WIDTH, MEMO_WORDS = 3000, 1 << 12, 400_000
#: Words of a stretch in which repetition is measured, so that it doesn't rise with the length of a text.
STRETCH = 400
#: A document is rejected if its score, the chance that it is good, is below this.
MIN_SCORE = 0.25
BAD, ABSTAIN, GOOD = 0, 1, 2

_UPPER, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
_SYMBOLS, _STOPS = b"#*$%&|<>", b".!?"
#: Frequent words of English, French, German and Spanish prose.
COMMON = frozenset(w.encode() for w in "the of and to in that is for de la le et les des en un der die und den von zu das que el y los se".split())


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _vote(value: float, good, bad) -> int:
    return GOOD if good(value) else BAD if bad(value) else ABSTAIN


def measures(text: bytes, words: list[bytes]) -> list[float]:
    """Words; symbols a word; capitals a letter; stops a word; share of common words; of repeated lines; of words new in their stretch; bytes a word."""
    n, letters = len(words), len(text) - len(text.translate(None, _LETTERS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        n,
        _share(len(text) - len(text.translate(None, _SYMBOLS)), n),
        _share(len(text) - len(text.translate(None, _UPPER)), letters),
        _share(len(text) - len(text.translate(None, _STOPS)), n),
        _share(sum(map(COMMON.__contains__, words)), n),
        1 - _share(len(set(lines)), len(lines)) if lines else 0.0,
        _share(sum(len(set(words[i : i + STRETCH])) for i in range(0, n, STRETCH)), n),
        _share(len(text), n),
    ]


#: Words from which the labellers of a share vote at all.
VOTING_WORDS = 20


def votes(m: list[float]) -> list[int]:
    """One vote per labeller, from the measures of a text; short texts get few votes."""
    n, symbols, upper, stops, common, again, distinct, per_word = m
    cast = [
        _vote(symbols, lambda x: x < 0.05, lambda x: x > 0.2),
        _vote(upper, lambda x: x < 0.15, lambda x: x > 0.4),
        _vote(stops, lambda x: 0.01 < x < 0.35, lambda x: x > 0.7),
        _vote(common, lambda x: x > 0.15, lambda x: x < 0.08),
        _vote(again, lambda x: x < 0.1, lambda x: x > 0.3),
        _vote(distinct, lambda x: x > 0.45, lambda x: x < 0.25),
        _vote(per_word, lambda x: 4 < x < 11, lambda x: x > 30),
    ]
    return cast if n >= VOTING_WORDS else [ABSTAIN] * len(cast)


N_LABELLERS = 7


def pattern(cast: list[int]) -> int:
    return sum(v * 3**k for k, v in enumerate(cast))


@dataclass
class LabelModel:
    """P(good) and, for each labeller and class, the share of its votes that are for good.

    Votes are independent given the class; an abstention says nothing.
    """

    prior: float
    says_good: np.ndarray  # labeller, class (bad, good)

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        log = np.log([1 - self.prior, self.prior]) + (cast == GOOD) @ np.log(self.says_good) + (cast == BAD) @ np.log(1 - self.says_good)
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))

    def accuracies(self) -> list[float]:
        """Of each labeller, when it votes: the chance that it is right."""
        return list((1 - self.prior) * (1 - self.says_good[:, 0]) + self.prior * self.says_good[:, 1])


def fit_labels(cast: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many documents have each.

    Each labeller is written to be rarely wrong when it says bad, so the first
    guess falls with every such vote.
    """
    good = 1 / (1 + np.exp(2.0 * (cast == BAD).sum(1) - 3.0))
    model = LabelModel(0.5, np.full((cast.shape[1], 2), 0.5))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good], 1)
        yes, no = (cast == GOOD).T @ weight + 1.0, (cast == BAD).T @ weight + 1.0
        model = LabelModel(float(np.clip(weight[:, 1].sum() / max(weight.sum(), 1), 0.01, 0.99)), yes / (yes + no))
        new = model.posterior(cast)
        if np.abs(new - good).max(initial=0) < 1e-6:
            break
        good = new
    return model


def shape(word: bytes) -> bytes:
    """The word with runs of capitals, letters, digits and each other byte shortened to one sign."""
    out = bytearray()
    for b in word:
        c = 65 if 65 <= b < 91 else 97 if b >= 128 or 97 <= b < 123 else 48 if 48 <= b < 58 else b
        if not out or out[-1] != c:
            out.append(c)
    return bytes(out)


class Hashed:
    """Feature numbers of words (the word, its shape) and of measures (which step of a scale)."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.memo: dict[bytes, tuple[int, int]] = {}

    def word(self, w: bytes) -> tuple[int, int]:
        got = self.memo.get(w)
        if got is None:
            got = crc32(b"w" + w.lower()) % self.width, crc32(b"s" + shape(w)) % self.width
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            if len(w) <= 64:
                self.memo[w] = got
        return got

    def scale(self, m: list[float]) -> list[int]:
        steps = [min(int(np.log2(m[0] + 1)), 20), *(min(int(x * 20), 40) for x in m[1:7]), min(int(m[7]), 40)]
        return [crc32(b"m%d:%d" % (k, s)) % self.width for k, s in enumerate(steps)]


#: How much a step of a measure weighs beside a text's words, which weigh 1 together.
SCALE = 0.25


def vector(text: bytes, hashed: Hashed) -> tuple[np.ndarray, np.ndarray]:
    words = text.split()
    x = np.zeros(hashed.width, np.float32)
    if words:
        pairs = np.array([hashed.word(w) for w in words])
        x += np.bincount(pairs.ravel(), minlength=hashed.width).astype(np.float32) / len(words)
    np.add.at(x, hashed.scale(measures(text, words)), SCALE)
    at = np.flatnonzero(x)
    return at.astype(np.int32), x[at]


def fit_scorer(x: np.ndarray, good: np.ndarray, rounds: int = 300, rate: float = 1.0, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes weighing the same, by Adam on the whole sample."""
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    if not len(x):
        return w, b
    if good.min() >= 0.5 or good.max() < 0.5:  # one side only: nothing to tell apart, so each score is the mean
        p = float(np.clip(good.mean(dtype=np.float64), 1e-6, 1 - 1e-6))
        return w, float(np.log(p / (1 - p)))
    weight = good / max(good.sum(), 1e-9) + (1 - good) / max((1 - good).sum(), 1e-9)
    weight = (weight / weight.sum()).astype(np.float32)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = (weight * (p - good)).astype(np.float32)
        g = np.append(x.T @ e + decay * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1].astype(np.float32), b - float(step[-1])
    return w, b


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float


def fraction(h: Column) -> Column:
    """A hash of 64 bits as a number from 0 below 2^63."""
    return F.shiftrightunsigned(h, 1)


def cutoff(total: int, train_rows: int) -> int:
    """Below this lie about twice train_rows of the fractions of so many hashes, all if there are fewer."""
    return min((2 * train_rows << 63) // max(total, 2 * train_rows, 1), (1 << 63) - 1)


def train_sample(docs: DataFrame, *, text: str = "text", key: str = "doc_id", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The texts of the train_rows distinct (key, text) of smallest hash, or of all if there are fewer.

    A threshold from the approximate number of distinct rows first leaves about twice
    as many, so that the sort sees a few thousand rows of any corpus; rows that repeat
    whole are one and collapse before the shuffle.
    """
    rows = docs.select(fraction(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))).alias("h"), F.col(f"`{text}`").alias("text"))
    many = rows.agg(F.approx_count_distinct("h", 0.05)).first()[0]
    some = rows.where(F.col("h") <= cutoff(many, train_rows)).groupBy("h").agg(F.first("text").alias("text"))
    return some.orderBy("h").limit(train_rows)


def fit(docs: DataFrame, *, text: str = "text", key: str = "doc_id", train_rows: int = TRAIN_ROWS) -> QualityModel:
    """Label model from the vote patterns of all rows (at most 3^7 counts reach the driver), scorer from a bounded sample.

    The sample, train_rows rows at most, is the only part that doesn't see every row.
    Where all of it is on one side of the label model, each score is the mean posterior.
    """

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pattern(votes(measures(x, x.split()))) for x in _bodies(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32())], names=["pattern"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hashed()
        for batch in batches:
            found, at, value = [], [], []
            for body in _bodies(batch.column("text")):
                found.append(pattern(votes(measures(body, body.split()))))
                i, v = vector(body, hashed)
                at.append(i)
                value.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(found, pa.int32()), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))], names=["h", "pattern", "at", "value"])

    bodies = docs.select(F.col(f"`{text}`").alias("text"))
    patterns = bodies.mapInArrow(cast, "pattern int").groupBy("pattern").count().collect()
    codes = np.array([r["pattern"] for r in patterns], np.int64)
    casts = np.stack([codes // 3**k % 3 for k in range(N_LABELLERS)], 1) if len(codes) else np.zeros((0, N_LABELLERS), np.int64)
    labels = fit_labels(casts, np.array([r["count"] for r in patterns], float))
    posterior = dict(zip(codes.tolist(), labels.posterior(casts).tolist(), strict=True)) if len(codes) else {}
    sample = train_sample(docs, text=text, key=key, train_rows=train_rows).mapInArrow(features, "h long, pattern int, at array<int>, value array<float>").collect()
    if posterior and not sample:
        raise ValueError("no row to train on")
    sample.sort(key=lambda r: r["h"])
    x, good = np.zeros((len(sample), WIDTH), np.float32), np.array([posterior[r["pattern"]] for r in sample], np.float32)
    for k, r in enumerate(sample):
        x[k, r["at"]] = r["value"]
    weights, bias = fit_scorer(x, good)
    return QualityModel(labels, weights, bias)


def _bodies(column: pa.Array) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


def classify(docs: DataFrame, model: QualityModel, *, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """docs with posterior (of the label model), score (of the scorer) and kept (score >= min_score) added.

    A null text counts as empty; texts below VOTING_WORDS words have no votes, so the
    label model's prior. A very long text is split into words in a worker's memory, one
    text at a time. Columns named like the results are replaced; all other columns,
    whatever their names, repeated rows and null keys pass through. A narrow map:
    nothing is shuffled, and the model that goes along has a fixed size.
    """
    names = ("posterior", "score", "kept")
    schema = docs.drop(*names).schema.add("posterior", "double").add("score", "double").add("kept", "boolean")
    weights, bias, labels = [float(x) for x in model.weights], float(model.bias), model.labels

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, memo, known = Hashed(), {}, {}
        for batch in batches:
            out = []
            for body in _bodies(batch.column(text)):
                words = body.split()
                try:
                    total = sum(map(memo.__getitem__, words))
                except KeyError:
                    total = 0.0
                    for w in words:
                        got = memo.get(w)
                        if got is None:
                            i, j = hashed.word(w)
                            got = weights[i] + weights[j]
                            if len(memo) >= MEMO_WORDS:
                                memo.clear()
                            memo[w] = got
                        total += got
                m = measures(body, words)
                z = bias + _share(total, len(words)) + SCALE * sum(weights[i] for i in hashed.scale(m))
                cast = tuple(votes(m))
                if cast not in known:
                    known[cast] = float(labels.posterior(np.array([cast]))[0])
                out.append((known[cast], 1 / (1 + np.exp(-min(max(z, -30), 30)))))
            cols = [pa.array([a for a, _ in out], pa.float64()), pa.array([b for _, b in out], pa.float64()), pa.array([bool(b >= min_score) for _, b in out], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *names])

    return docs.drop(*names).mapInArrow(score, schema)


def quality_classifier(docs: DataFrame, *, text: str = "text", key: str = "doc_id", train_rows: int = TRAIN_ROWS, min_score: float = MIN_SCORE) -> DataFrame:
    """Fits on docs and classifies all of them; see fit and classify. An empty table gives no rows."""
    return classify(docs, fit(docs, text=text, key=key, train_rows=train_rows), text=text, min_score=min_score)
