"""Token ids of whole texts by a public tokenizer file, as little-endian unsigned 32-bit bytes.

Texts repeat their words, and encoding a word costs far more than looking it up. White space is
never part of a token, so the stretches between spaces are encoded one by one and remembered for
as long as the Python worker lives. What is remembered is bounded and does not change results.
"""

from __future__ import annotations

import json
import string
import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of stretches that a worker remembers unless told otherwise, half of them young, what one
#: takes besides its text and ids, and the longest of them.
REMEMBERED_BYTES, ENTRY_BYTES, LONGEST = 24 << 20, 100, 64
#: The id that ends each document.
END_ID = 1

_MARKS = string.punctuation.replace("'", "")
_LAST_LATIN = "ɏ"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Known(dict):
    """Ids by stretch; ``learn`` gives those of a stretch that is not there.

    When there are enough, they become the old ones, and those that are asked for again are young
    once more. Old ones go when the young have become enough again, so what is frequent stays.
    """

    def __init__(self, learn: Callable[[str], bytes], most: int):
        self.learn, self.most = learn, most
        self.old: dict[str, bytes] = {}
        self.bytes = 0

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.learn(chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = ids
            self.bytes += len(chunk) + len(ids) + ENTRY_BYTES
        return ids

    def age(self) -> None:
        if self.bytes > self.most // 2:
            self.old = dict(self)
            self.clear()
            self.bytes = 0


def _splits_at_spaces(tokenizer) -> bool:
    """Whether white space is dropped, letters are lower-cased, and runs of letters stand alone."""
    parts = json.loads(tokenizer.to_str())
    normalizers = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
    splits = [p for p in (parts["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
    dropped = any(p["behavior"] == "Removed" and p["invert"] for p in splits)
    return normalizers == ["NFC", "Replace", "Lowercase"] and dropped


class Encoder:
    """Whole texts to ids; equal to encoding each text at once with the tokenizers library.

    Tokenizers that do not split at spaces get whole texts.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_BYTES):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.size = max(self._tokenizer.get_vocab().values()) + 1
        self._tokenize = self._tokenizer.model.tokenize
        self._known = _Known(self._learn, remembered)
        # How the model spells letters.
        letters = [chr(i) for i in range(ord(_LAST_LATIN) + 1) if chr(i).isalpha()]
        split = self._tokenizer.pre_tokenizer.pre_tokenize_str if self._tokenizer.pre_tokenizer else lambda c: [(c, None)]
        self._spelled = {ord(c): "".join(piece for piece, _ in split(c)) for c in letters}
        self._by_stretch = _splits_at_spaces(self._tokenizer)

    def __call__(self, text: str) -> bytes:
        if not self._by_stretch:
            return self._encode(text).tobytes()
        self._known.age()
        chunks = text.replace("\n", " ").replace("\t", " ").split(" ")
        return b"".join(map(self._known.__getitem__, chunks))

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, chunk: str) -> bytes:
        word = chunk.rstrip(_MARKS)
        if not _plain(word):
            return self._encode(chunk).tobytes()
        # Letters and then marks are two tokens' worth of text, whatever stands around.
        lower = word.lower()
        if lower != chunk:
            ids = self._known[lower]
        else:
            spelled = lower if lower.isascii() else lower.translate(self._spelled)
            ids = _four_bytes([token.id for token in self._tokenize(spelled)])
        return ids + self._known[chunk[len(word):]] if len(word) < len(chunk) else ids


def _four_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers; for few of them much faster than an array."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _plain(word: str) -> bool:
    """Whether a word is Latin letters that need no more normalizing than to be lower-cased.

    A capital I with a dot does: it becomes two signs, and the second is no letter.
    """
    if not word.isalpha():
        return False
    return word.isascii() or (max(word) <= _LAST_LATIN and (lower := word.lower()).isalpha() and is_normalized("NFC", lower))


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED_BYTES) -> Encoder:
    """This worker's encoder for a tokenizer file; a worker has one at a time."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, remembered] = Encoder(path, remembered)
    return _ENCODERS[path, remembered]


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While a step runs, pass at most so many rows to Python at once.

    Whole texts are large rows: by Spark's default some ten thousand of them would be held at once,
    in the JVM and in Python, by every task.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``text`` of every row; a null text is empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def encoded(batches: Iterator[pa.RecordBatch], path: str, remembered: int = REMEMBERED_BYTES) -> Iterator[tuple[int | None, bytes]]:
    """Identifier and ids, with the end id, of each row of ``texts_of``."""
    encode, end = encoder(path, remembered), np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield doc, encode(text.as_py()) + end


def batched(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int] | None = None,
            most: int = 1 << 14, most_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of a bounded number of rows and, by ``size``, bytes."""
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += size(row) if size else 0
        if len(held) >= most or held_bytes >= most_bytes:
            yield _batch(held, schema)
            held, held_bytes = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
