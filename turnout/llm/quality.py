"""Quality classifier: supervised subword embeddings.

A text's features are its words, the character n-grams of its words and its pairs of neighbouring
words (by the shapes of both and whether they are equal), each hashed to a learned vector. The
vectors are averaged over the text, and a softmax layer tells the classes apart. Vectors and layer
are trained together by stochastic gradient descent in numpy, on a bounded sample.

For scoring, vectors and layer come down to one number per feature. A word's features are summed
once and remembered, within a bound, for as long as a Python worker works on a partition.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout.llm.labelled import training_texts
from turnout.llm.tokens import texts_of

#: Hashed features, the size of their vectors, character n-grams, and what a worker remembers:
#: words, and how long ones.
BUCKETS, DIM, GRAMS, REMEMBERED, LONGEST = 1 << 17, 8, (3, 4, 5), 1 << 19, 64
#: Most labelled documents that the classifier is fitted on, and how.
MOST_TRAINING, EPOCHS, RATE, SEED = 3000, 10, 0.5, 0

_CLASSES = [(re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[0-9]+"), b"0")]
_REPEATED = re.compile(rb"([^Aa0])\1+")


def _bucket(key: bytes) -> int:
    return zlib.crc32(key) & (BUCKETS - 1)


def word_features(word: bytes) -> np.ndarray:
    """Buckets of a word and of all its character n-grams, with marks for its ends."""
    marked = b"<" + word + b">"
    grams = (_bucket(marked[i : i + n]) for n in GRAMS for i in range(len(marked) - n + 1))
    return np.fromiter(chain([_bucket(b"word " + word)], grams), np.uint32)


def shape(word: bytes) -> bytes:
    """The kinds of characters in a word, runs as one: ``Word,`` gives ``Aa,``; long ones hashed."""
    for pattern, sign in _CLASSES:
        word = pattern.sub(sign, word)
    kinds = _REPEATED.sub(rb"\1\1", word)
    return kinds if len(kinds) <= 8 else b"# %08x" % zlib.crc32(kinds)


def pair_feature(left: bytes, right: bytes, equal: bool) -> int:
    return _bucket(b"pair %s %s %d" % (left, right, equal))


def features(text: str) -> np.ndarray:
    """The buckets of all features of a text, repeated as they occur."""
    words = text.encode().split()
    found = np.concatenate([np.zeros(0, np.uint32), *map(word_features, words)])
    shapes = [shape(word) for word in words]
    pairs = [pair_feature(shapes[i], shapes[i + 1], words[i] == words[i + 1]) for i in range(len(words) - 1)]
    # A pair says as much as a word does with all its n-grams.
    weight = max(1, len(found) // max(1, len(words)))
    return np.concatenate([found, np.tile(np.array(pairs, np.uint32), weight)]).astype(np.int64)


@dataclass
class Model:
    """What each feature adds to the difference of the two classes, and what all texts have."""

    contribution: np.ndarray
    bias: float


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> Model:
    """Fit on ``(label, buckets, counts)``; without examples of both labels the score is their share."""
    labels = np.array([label for label, _, _ in examples])
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1.0)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / DIM, 1.0 / DIM, (BUCKETS, DIM))
    layer, bias = rng.uniform(-0.1, 0.1, (2, DIM)), np.zeros(2)
    steps, step = epochs * len(examples), 0
    # Both labels count alike, however rare one is, as far as a factor of 5.
    alike = np.clip(len(labels) / (2.0 * np.bincount(labels, minlength=2)), 0.2, 5.0)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            label, buckets, counts = examples[i]
            step_rate = rate * (1 - step / steps)
            step += 1
            if not len(buckets):
                continue
            share = (counts / counts.sum())[:, None]
            hidden = (vectors[buckets] * share).sum(0)
            logits = layer @ hidden + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1.0
            error *= alike[label]
            back = layer.T @ error
            layer -= step_rate * np.outer(error, hidden)
            bias -= step_rate * 0.1 * error
            # Each feature carries a small share of the text; the factor keeps its vector learning.
            vectors[buckets] -= step_rate * np.minimum(1.0, share * 20.0) * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


class _Words(dict):
    """Number of each word seen; new ones are listed until their sums are made."""

    def __init__(self):
        self.new: list[bytes] = []
        self.numbered = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = self.numbered
        self.numbered += 1
        self.new.append(word)
        return n


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.words = _Words()
        self.sums, self.sizes, self.shapes = np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
        self.shape_ids: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.pairs: dict[int, float] = {}

    def _shape_id(self, name: bytes) -> int:
        if name not in self.shape_ids:
            self.shape_ids[name] = len(self.names)
            self.names.append(name)
        return self.shape_ids[name]

    def _learn(self) -> None:
        """Sums of the new words; a long one is summed alone and its bytes are forgotten."""
        new = self.words.new
        if new:
            sums, sizes = np.zeros(len(new)), np.zeros(len(new))
            short = [i for i, word in enumerate(new) if len(word) <= LONGEST]
            if short:
                found = [word_features(new[i]) for i in short]
                sizes[short] = n = np.array([len(f) for f in found])
                flat = self.model.contribution[np.concatenate(found)].astype(float)
                sums[short] = np.add.reduceat(flat, np.cumsum(n) - n)
            for i in set(range(len(new))).difference(short):
                one = word_features(new[i])
                sums[i], sizes[i] = self.model.contribution[one].sum(dtype=float), len(one)
                del self.words[new[i]]
            shapes = [self._shape_id(shape(w)) for w in new]
            self.sums, self.sizes = np.append(self.sums, sums), np.append(self.sizes, sizes)
            self.shapes = np.append(self.shapes, shapes)
            self.words.new = []

    def _pair_sums(self, words: np.ndarray) -> float:
        shapes = self.shapes[words]
        keys = (shapes[:-1] << 32) | (shapes[1:] << 1) | (words[:-1] == words[1:])
        kinds, counts = np.unique(keys, return_counts=True)
        total = 0.0
        for key, n in zip(kinds.tolist(), counts.tolist()):
            if key not in self.pairs:
                bucket = pair_feature(self.names[key >> 32], self.names[(key & 0xFFFFFFFF) >> 1], bool(key & 1))
                self.pairs[key] = float(self.model.contribution[bucket])
            total += n * self.pairs[key]
        return total

    def __call__(self, texts: list[str]) -> list[float]:
        if max(self.words.numbered, len(self.pairs)) > REMEMBERED:
            self.clear()
        parts = [text.encode().split() for text in texts]
        numbers = [np.fromiter(map(self.words.__getitem__, p), np.int64, len(p)) for p in parts]
        self._learn()
        scores = []
        for words in numbers:
            total, n = self.sums[words].sum(), self.sizes[words].sum()
            if len(words) > 1:
                weight = max(1, int(n) // len(words))
                total += weight * self._pair_sums(words)
                n += weight * (len(words) - 1)
            logit = total / max(n, 1) + self.model.bias
            scores.append(float(1 / (1 + np.exp(-np.clip(logit, -50, 50)))))
        return scores


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, label: str = "quality",
        most: int = MOST_TRAINING, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on at most ``most`` labelled documents; their features are made by executors."""

    def prepare(batches):
        for batch in batches:
            for want, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                buckets, counts = np.unique(features(text.as_py()), return_counts=True)
                columns = [[want], [buckets.astype("<u4").tobytes()], [counts.astype("<u4").tobytes()]]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))],
                                      names=["label", "buckets", "counts"])

    rows = training_texts(docs, labels, label, trainable, most, id_col, text_col).mapInArrow(
        prepare, "label int, buckets binary, counts binary"
    ).collect()
    examples = sorted((r.label, bytes(r.buckets), bytes(r.counts)) for r in rows)
    del rows
    return train([(label, np.frombuffer(b, "<u4"), np.frombuffer(c, "<u4")) for label, b, c in examples])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row, by its whole text.

    A null or empty text has no features; its score is what all texts have in common. Repeated
    rows are scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = scorer(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return texts_of(docs, id_col, text_col).mapInArrow(judge, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose whole text scores less than ``least``; all columns stay.

    Texts without words say nothing about their quality and stay.
    """
    shared, schema = docs.sparkSession.sparkContext.broadcast(model), docs.schema
    column = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [text or "" for text in part.column(column).to_pylist()]
                good = [score >= least or not text.split() for score, text in zip(scorer(texts), texts)]
                yield part.filter(pa.array(good))

    return docs.mapInArrow(keep, schema)
