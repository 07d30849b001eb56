"""Ranked lexical search: term at a time over an inverted index, with limited accumulators.

The index is a table of blocks of documents of bounded text; each block holds its terms with their
postings, so blocks are ranked independently, wherever they lie. An item's terms are taken rarest
first. Each adds its weight to the accumulators of the documents that have it; once the terms that
are left cannot lift a new document to the kth best score, no accumulators are created any more,
those that can still get there go on, and their scores are exact. A task carries each item's best
scores from block to block, so most of its blocks need few accumulators or none.

Scores are whole numbers, so the order in which terms and documents come changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnout.llm.tokens import batched, texts_of
from turnout.sinks import has_files, shared_dir

#: Bytes of text in a block of the index and looked at together; terms of items ranked in one pass.
BLOCK_BYTES, PART_BYTES, PASS_TERMS = 1 << 23, 1 << 20, 1 << 17

# Terms are runs of ASCII letters and digits and of all bytes of other characters.
_KEPT = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
_TERM_BYTES = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _KEPT else 0x20 for b in range(256))

_BLOCK = "n_docs bigint, n_terms bigint, doc_ids array<bigint>, lengths binary, terms binary, dfs binary, docs binary, tfs binary"
_ARROW_BLOCK = pa.schema([
    ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()),
    ("terms", pa.binary()), ("dfs", pa.binary()), ("docs", pa.binary()), ("tfs", pa.binary()),
])
_ARROW_TERM = pa.schema([("id", pa.int64()), ("term", pa.binary())])
_ITEM = "id bigint, terms array<binary>"
_FOUND = "item_id bigint, doc_id bigint, score bigint"
_ARROW_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str) -> Iterator[list[bytes]]:
    """A text's terms in order, some at a time."""
    data = text.encode().translate(_TERM_BYTES)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PART_BYTES)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


# --- index ----------------------------------------------------------------------------------


class _Numbers(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def block_of(rows: list[tuple[int | None, str]]) -> tuple | None:
    """A block's row: documents that have terms, and the postings of each term in their order."""
    numbers, ids, counts, found = _Numbers(), [], [], []
    for doc, text in rows:
        parts = [np.fromiter(map(numbers.__getitem__, part), np.int64, len(part)) for part in terms_of(text)]
        n = sum(map(len, parts))
        if n:
            ids.append(doc)
            counts.append(n)
            found += parts
    if not ids:
        return None
    owner = np.repeat(np.arange(len(ids)), counts)
    pairs, tfs = np.unique(np.concatenate(found) * len(ids) + owner, return_counts=True)
    dfs = np.bincount(pairs // len(ids), minlength=len(numbers))
    return (
        len(ids), sum(counts), ids, np.array(counts, "<u4").tobytes(), b" ".join(numbers), dfs.astype("<u4").tobytes(),
        (pairs % len(ids)).astype("<u4").tobytes(), tfs.astype("<u4").tobytes(),
    )


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index of all whole texts under ``path``; the index as a table of blocks.

    Null and empty texts, and those without terms, have no part in it. Every row is a document of
    its own, also rows that repeat an id or have none. A text longer than a block makes a longer
    block; other columns of ``docs`` are not read. An empty table gives an empty index.
    """

    def blocks(batches):
        def rows():
            held, size = [], 0
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    held.append((doc, text.as_py()))
                    size += len(held[-1][1])
                    if size >= BLOCK_BYTES:
                        yield block_of(held)
                        held, size = [], 0
            if held:
                yield block_of(held)

        yield from batched((row for row in rows() if row), _ARROW_BLOCK, most=1)

    built = texts_of(docs, id_col, text_col).mapInArrow(blocks, _BLOCK)
    built.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_BLOCK).parquet(path)


# --- ranking --------------------------------------------------------------------------------


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def best_docs(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the k best with at least ``least``, and their exact scores.

    ``lists`` are the documents and gains of each term, rarest first. Every document with a score
    of ``least`` or more that ``k`` others do not surpass is there.
    """
    left = np.cumsum([0, *(gains.max() for _, gains in reversed(lists))])[::-1]
    scores, open_to = np.zeros(n_docs, np.int64), None
    for (docs, gains), rest in zip(lists, left[1:]):
        if open_to is None:
            scores[docs] += gains
        else:
            on = open_to[docs]
            scores[docs[on]] += gains[on]
        reach = least
        if n_docs > k and rest:
            reach = max(reach, int(np.partition(scores, n_docs - k)[n_docs - k]))
        if rest < reach:
            # A document without an accumulator can no longer come in, nor one that is too far off.
            open_to = scores + rest >= reach
    docs = np.flatnonzero((scores > 0) & (scores >= least) if open_to is None else (scores > 0) & (scores >= least) & open_to)
    return docs, scores[docs]


@dataclass
class Best:
    """An item's best documents so far, best first: score descending, then id, null ids last."""

    scores: np.ndarray
    ids: np.ndarray
    absent: np.ndarray

    def least(self, k: int) -> int:
        return int(self.scores[-1]) if len(self.scores) == k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, absent: np.ndarray, k: int) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        absent = np.concatenate([self.absent, absent])
        order = np.lexsort((ids, absent, -scores))[:k]
        self.scores, self.ids, self.absent = scores[order], ids[order], absent[order]


def _postings(row: dict, wanted: dict[bytes, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, documents and occurrences of each wanted term of a block."""
    docs, tfs = np.frombuffer(row["docs"], "<u4"), np.frombuffer(row["tfs"], "<u4")
    ends = np.cumsum(np.frombuffer(row["dfs"], "<u4"), dtype=np.int64)
    for at, term in enumerate(row["terms"].split(b" ")):
        number = wanted.get(term)
        if number is not None:
            a, b = ends[at - 1] if at else 0, ends[at]
            yield number, docs[a:b].astype(np.int64), tfs[a:b].astype(np.int64)


def _groups(rows: Iterator[tuple[int, list[bytes]]]) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items with their terms, as many together as one pass may have terms."""
    group: list[tuple[int, list[bytes]]] = []
    size = 0
    for item, terms in rows:
        if group and size + len(terms) > PASS_TERMS:
            yield group
            group, size = [], 0
        group.append((item, [bytes(term) for term in terms]))
        size += len(terms)
    if group:
        yield group


def _rank_group(index: DataFrame, group: list[tuple[int, list[bytes]]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item_id, doc_id, score``: at least the k best of each item of a group, from all blocks."""
    spark = index.sparkSession
    of_terms = {term: number for number, term in enumerate(sorted({term for _, terms in group for term in terms}))}
    shared = spark.sparkContext.broadcast(of_terms)  # at most PASS_TERMS, or one item's

    def count(batches):
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, dfs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [(wanted[term], at) for at, term in enumerate(terms.split(b" ")) if term in wanted]
                if found:
                    numbers, places = np.array(found).T
                    total[numbers] += np.frombuffer(dfs, "<u4")[places]
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["term", "df"])

    counted = index.select("terms", "dfs").mapInArrow(count, "term bigint, df bigint")
    # A row per term of the group at most.
    dfs = dict(map(tuple, counted.groupBy("term").agg(F.sum("df")).collect()))
    weights = np.zeros(len(of_terms), np.int64)
    for number, df in dfs.items():
        weights[number] = weight(n_docs, df)
    # Rarest first.
    items = [
        (item, sorted((n for n in map(of_terms.__getitem__, terms) if weights[n] > 0), key=lambda n: (-weights[n], n)))
        for item, terms in group
    ]
    ranked = spark.sparkContext.broadcast((weights, items))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = ranked.value
        none = np.zeros(0, np.int64)
        best = [Best(none, none, np.zeros(0, bool)) for _ in items]
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in _ARROW_BLOCK.names}
                absent = np.array([doc is None for doc in row["doc_ids"]])
                ids = np.array([doc or 0 for doc in row["doc_ids"]], np.int64)
                length = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                m = 50 + (50 * length * n_docs) // n_terms
                lists = {}
                for number, docs, tfs in _postings(row, shared.value):
                    gains = weights[number] * (1_000_000_000 * tfs // (1000 * tfs + 20 * m[docs]))
                    lists[number] = docs, gains, int(gains.max())
                for (_, numbers), own in zip(items, best):
                    here = [lists[n] for n in numbers if n in lists]
                    if sum(most for _, _, most in here) < own.least(k):
                        continue
                    docs, scores = best_docs([(d, g) for d, g, _ in here], row["n_docs"], k, own.least(k))
                    own.add(scores, ids[docs], absent[docs], k)
        rows = (
            (item, None if gone else int(doc), int(score))
            for (item, _), own in zip(items, best) for score, doc, gone in zip(own.scores, own.ids, own.absent)
        )
        yield from batched(rows, _ARROW_FOUND)

    return index.mapInArrow(rank, _FOUND)


def rank(index: DataFrame, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0.

    ``index`` is what ``build_index`` gives. Equal scores come by ascending id, null ids last. Items
    without terms or without a matching document, and rows without an item id, have no result; rows
    that repeat an item id are one item with the terms of all. Items are ranked in groups of a
    bounded number of terms, each in one pass over the index; one item is never divided.
    """
    spark = index.sparkSession
    root = shared_dir(spark, "lexical")

    def terms(batches):
        for batch in batches:
            rows = ((item, term) for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for term in sorted({term for part in terms_of(text) for term in part}))
            yield from batched(rows, _ARROW_TERM)

    named = texts_of(items.where(F.col(id_col).isNotNull()), id_col, text_col)
    merged = named.mapInArrow(terms, "id bigint, term binary").distinct().groupBy("id").agg(F.collect_list("term").alias("terms"))
    merged.write.parquet(f"{root}/items")
    rows = spark.read.schema(_ITEM).parquet(f"{root}/items").toLocalIterator()
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    found = spark.createDataFrame([], _FOUND)
    if n_docs:
        # One group at a time: the driver holds no more than that.
        for number, group in enumerate(_groups(rows)):
            _rank_group(index, group, n_docs, n_terms, k).write.parquet(f"{root}/found/{number}")
        if has_files(spark, f"{root}/found"):
            found = spark.read.schema(_FOUND).option("recursiveFileLookup", "true").parquet(f"{root}/found")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
