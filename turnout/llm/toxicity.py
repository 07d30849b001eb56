"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the character n-grams of its distinct lower-cased words, hashed, as often as
those words have them. Each is scaled by the log of how much more often it is in toxic training
texts than in others, and a logistic layer is fitted on the scaled features in numpy, on a bounded
sample. Rare features are not cut off: a ratio shrinks with how few other texts it rests on.

Both the layer's sum and the length of the scaled features add up over words, so a word's part is
computed once, by rolling hashes over many words at a time, and remembered within a bound. Parts
are whole numbers, so a score does not depend on the order of words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout.llm.jaccard import mixed
from turnout.llm.labelled import training_texts
from turnout.llm.tokens import texts_of

#: Hashed features, character n-grams, words that a worker remembers and how long ones, and bytes
#: of words looked at together.
BUCKETS, GRAMS, REMEMBERED, LONGEST, TOGETHER = 1 << 20, (3, 4, 5, 6, 7, 8), 1 << 18, 64, 1 << 18
#: Most labelled documents that the classifier is fitted on; smoothing of their counts; the square of
#: a ratio in standard errors at which it counts half; how much more the rarer label may count.
MOST_TRAINING, SMOOTHING, SHRINK, ALIKE = 3000, 1.0, 16.0, 3.0
STEPS, RATE, PENALTY = 100, 0.1, 1e-2
#: Parts are kept in such steps.
UNIT = 1 << 20

_UPPER_TO_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.arange(16, dtype=np.uint64) * _FACTOR
_LOW = (1 << 64) - 1


def words_of(text: str) -> set[bytes]:
    return set(text.encode().translate(_UPPER_TO_LOWER).split())


def gram_buckets(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For bounded stretches of the words: which word each n-gram is of, and its bucket.

    A word's ends are marked, so they are part of n-grams.
    """
    data = np.frombuffer(b"".join(b"<" + word + b">" for word in words), np.uint8)
    sizes = np.array([len(word) + 2 for word in words], np.int64)
    ends = np.cumsum(sizes)
    for a in range(0, len(data), TOGETHER):
        part = data[a : a + TOGETHER + max(GRAMS)].astype(np.uint64)
        n = min(TOGETHER, len(data) - a)
        owner = np.searchsorted(ends, np.arange(a, a + n), side="right")
        left = ends[owner] - np.arange(a, a + n)
        rolled = part + np.uint64(1)
        for size in range(1, max(GRAMS) + 1):
            if size in GRAMS:
                whole = np.flatnonzero(left >= size)
                keys = mixed(rolled[whole] + _SALT[size])
                yield owner[whole], (keys & np.uint64(BUCKETS - 1)).astype(np.int32)
            if size < max(GRAMS):
                after = part[size:] + np.uint64(1)
                rolled = np.append(rolled[: len(after)] * _FACTOR + after, rolled[len(after):])


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets and how often it has each."""
    found = [buckets for _, buckets in gram_buckets(sorted(words_of(text)))]
    return np.unique(np.concatenate([np.zeros(0, np.int32), *found]), return_counts=True)


def ratios(n_toxic: float, n_other: float, toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log-count ratio of each feature, by the number of texts of each kind that have it.

    Smoothed, and shrunk where it is small against its own standard error, as the ratios of rare
    and of neutral features are: long texts have very many of those.
    """
    ratio = np.log((SMOOTHING + toxic) / (n_toxic + 2 * SMOOTHING)) - np.log((SMOOTHING + other) / (n_other + 2 * SMOOTHING))
    evidence = ratio**2 / (1 / (SMOOTHING + toxic) + 1 / (SMOOTHING + other))
    return np.where(toxic + other > 0, ratio * evidence / (evidence + SHRINK), 0.0)


class Model:
    """Per bucket its part of the layer's sum and of the squared length, in steps; and the bias."""

    def __init__(self, weight: np.ndarray, ratio: np.ndarray, bias: float):
        self.sums = np.rint(np.clip(weight * ratio, -1000, 1000) * UNIT).astype(np.int32)
        self.squares = np.rint(ratio**2 * UNIT).astype(np.int32)
        self.bias = bias


def train(examples: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """Fit on label, buckets and counts of texts.

    Without examples of both labels all texts get the share of toxic ones.
    """
    labels = np.array([label for label, _, _ in examples], float)
    n, n_toxic = len(labels), labels.sum()
    bias = float(np.log((n_toxic + 0.5) / (n - n_toxic + 0.5)))
    texts, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    if n_toxic in (0, n):
        return Model(texts, toxic, bias)
    for label, found, _ in examples:
        texts[found] += 1
        toxic[found] += label
    ratio = ratios(n_toxic, n - n_toxic, toxic, texts - toxic)
    used = np.flatnonzero(ratio)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    own = ratio[used].astype(np.float32)
    # All texts one after the other, in small types; each step goes over them part by part.
    sizes = [int((place[found] >= 0).sum()) for _, found, _ in examples]
    cols, values = np.empty(sum(sizes), np.int32), np.empty(sum(sizes), np.float32)
    ends = np.cumsum(sizes)
    for (_, found, counts), size, end in zip(examples, sizes, ends):
        at = place[found]
        cols[end - size : end] = at[at >= 0]
        scaled = counts[at >= 0] * own[at[at >= 0]]
        values[end - size : end] = scaled / _length((scaled * own[at[at >= 0]]).sum(dtype=float))
    rows = np.repeat(np.arange(n, dtype=np.int32), sizes)
    parts = [slice(a, a + TOGETHER) for a in range(0, len(cols), TOGETHER)]
    # Both labels count alike, up to a factor.
    alike = np.clip(n / 2 / np.where(labels == 1, n_toxic, n - n_toxic), 1 / ALIKE, ALIKE) / n
    weight, mean, square = (np.zeros(len(used)) for _ in range(3))
    bias_mean = bias_square = 0.0
    for step in range(1, STEPS + 1):
        logit = bias + sum(np.bincount(rows[p], weights=values[p] * weight[cols[p]], minlength=n) for p in parts)
        error = (1 / (1 + np.exp(-logit)) - labels) * alike
        gradient = PENALTY / n * weight
        for p in parts:
            np.add.at(gradient, cols[p], values[p] * error[rows[p]])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        bias_mean, bias_square = 0.9 * bias_mean + 0.1 * error.sum(), 0.999 * bias_square + 0.001 * error.sum() ** 2
        rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        weight -= rate * mean / (np.sqrt(square) + 1e-8)
        bias -= rate * bias_mean / (np.sqrt(bias_square) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[used] = weight
    return Model(weights, ratio, float(bias))


def _length(squares: np.ndarray | float) -> np.ndarray | float:
    """Texts differ much in size, so a text's features share one length, or less if they say little."""
    return np.maximum(np.sqrt(squares), 1.0)


class Scorer:
    """Probability that a text is toxic, by parts of its words."""

    def __init__(self, model: Model):
        self.model = model
        self.parts: dict[bytes, int] = {}

    def _learn(self, words: list[bytes]) -> None:
        sums, squares = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for owner, buckets in gram_buckets(words):
            # Owners ascend, so each one's n-grams lie together.
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            if len(first):
                sums[owner[first]] += np.add.reduceat(self.model.sums[buckets].astype(np.int64), first)
                squares[owner[first]] += np.add.reduceat(self.model.squares[buckets].astype(np.int64), first)
        # One number holds both, so that they are added up together.
        self.parts.update((word, (a << 64) + b) for word, a, b in zip(words, sums.tolist(), squares.tolist()))

    def __call__(self, texts: list[str]) -> list[float]:
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        words = [words_of(text) for text in texts]
        new = sorted(set().union(*words).difference(self.parts))
        if new:
            self._learn(new)
        scores = []
        for own in words:
            total = sum(map(self.parts.__getitem__, own))
            logit = (total >> 64) / UNIT / float(_length((total & _LOW) / UNIT)) + self.model.bias
            scores.append(float(1 / (1 + np.exp(-np.clip(logit, -50, 50)))))
        for word in new:
            if len(word) > LONGEST:
                del self.parts[word]
        return scores


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, label: str = "toxic",
        most: int = MOST_TRAINING, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on at most ``most`` labelled documents; their features are made by executors."""

    def prepare(batches):
        for batch in batches:
            for want, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, counts = features(text.as_py())
                columns = [[want], [found.astype("<u4").tobytes()], [np.minimum(counts, 65535).astype("<u2").tobytes()]]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))],
                                      names=["label", "found", "counts"])

    rows = training_texts(docs, labels, label, trainable, most, id_col, text_col).mapInArrow(
        prepare, "label int, found binary, counts binary"
    ).toArrow()
    found, counts = (
        [np.frombuffer(value.as_buffer() or b"", kind) for value in rows[name]] for name, kind in (("found", "<u4"), ("counts", "<u2"))
    )
    # In an order of their own, however the rows came.
    order = sorted(range(rows.num_rows), key=lambda i: (rows["label"][i].as_py(), zlib.crc32(found[i].tobytes()), len(found[i])))
    return train([(rows["label"][i].as_py(), found[i], counts[i]) for i in order])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row, by its whole text.

    A null or empty text has no features; its score is the share of toxic training texts as the
    classifier sees it. Repeated rows are scored each. Other columns are not read; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two numbers per bucket

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = scorer(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return texts_of(docs, id_col, text_col).mapInArrow(judge, "doc_id bigint, score double")
