"""Exact Jaccard self-join of documents as sets of word n-grams, by a partition of the universe.

Two sets whose Jaccard similarity reaches the threshold differ in at most H elements. All elements
are hashed into segments, so if the segments can absorb more than H differences, one segment
agrees. How many segments there are depends on the band of sizes that the larger set is in. Each
band's allocation takes the cheaper of two ways to spend the H + 1:

- exact segments, a few more than needed; each set leaves out as many of its keys, those of its
  smallest segments, which select least. Both sets order shared keys alike, so one remains shared.
- segments that tolerate one difference: a set has, beside the key of the segment, the key with
  each one element deleted. For small sets, whose segments would be almost empty otherwise.

Sets that share a key are candidates, most of them by chance. They are placed in blocks of bounded
size by the least document they share a key with, and blocks that share a key are compared, twice:
first by signatures, the numbers of elements in equal parts of the universe. Two sets differ in at
least as many elements as their signatures do, so most pairs are out at a thirtieth of the cost
and none that is linked is lost. What is left falls into small groups, and only for those are the
sets themselves moved and their common elements counted exactly. A pair of blocks gives a spanning
forest of its links, not all.

An element is a 64-bit hash of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnout.llm.components import components
from turnout.llm.tokens import batched, rows_per_batch, texts_of
from turnout.sinks import shared_dir

#: Bands grow by this factor.
BAND_GROWTH = 1.4
#: What a segment of no, one or two elements costs, in keys; such keys are shared by chance.
SMALL_COSTS = (256.0, 32.0, 2.0)
#: Elements in a block; distinct words and sets that a worker remembers; keys that travel together.
BLOCK, REMEMBERED, SEEN, KEYS = 1 << 19, 1 << 16, 1 << 15, 1 << 18
#: Sets of fewer elements have no signature; the largest number that a part of one holds; elements
#: of sets in a block that is compared by signatures.
LEAST_SIGNED, MOST_COUNTED, SIGNED_BLOCK = 64, 255, 1 << 21

_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


# --- sets -----------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


def shingles(text: str, width: int, words: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct hashes of a text's ``width``-word runs, A-Z lower-cased.

    A text with fewer words has one run of all of them, one without words has none.
    """
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    numbers = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    runs = max(1, len(found) - width + 1)
    total = np.full(runs, min(width, len(found)), np.uint64)
    for i in range(min(width, len(found))):
        factor = np.uint64(_ODD[i % len(_ODD)] + 2 * (i // len(_ODD)))
        total += mixed(numbers[i : i + runs] + np.uint64(i)) * factor
    return np.unique(mixed(total))


# --- keys -----------------------------------------------------------------------------------


@lru_cache(maxsize=None)
def band_starts() -> np.ndarray:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_GROWTH)))
    return np.array(starts)


def most_differences(size: int, percent: int) -> int:
    """The most elements that two sets of at most ``size`` can differ in and still be linked."""
    return 2 * size * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def allocation(band: int, percent: int) -> tuple[int, int, int]:
    """Segments that tolerate a difference, exact segments, and exact keys each set leaves out.

    Always ``2 * tolerant + exact - left_out > H``. Costs are keys made and, dearer, segments of at
    most two elements among those kept, for a set at the low end of the band. Spare segments cost
    no keys, since as many are left out, but make all segments smaller.
    """
    low, high = int(band_starts()[band]), int(band_starts()[band + 1]) - 1
    need = most_differences(high, percent) + 1
    if need == 1:
        return 0, 1, 0

    def cost(m: int, share: float, left_out: int, each: float) -> float:
        """Of segments with few elements, smallest left out first, with room for two deviations."""
        total, chance = 0.0, exp(-share)
        for count, dear in enumerate(SMALL_COSTS):
            there = m * chance + 2 * sqrt(m * chance)
            gone = min(there, left_out)
            left_out -= gone
            total += dear * each * (there - gone)
            chance *= share / (count + 1)
        return total

    spares = {*range(9), *(need * i // 8 for i in range(1, 9))}
    choices = [(need + cost(need + s, low / (need + s), s, 1.0), (0, need + s, s)) for s in spares]
    tolerant = -(-need // 2)
    share = low / tolerant
    # A tolerant segment is as good as one that has an element less, and that is so for each of its keys.
    choices.append((tolerant + high + cost(tolerant, max(0.0, share - 1), 0, 1 + share), (tolerant, 0, 0)))
    return min(choices)[1]


def keys_of(elements: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set, for its own band and those of larger sets that it may be linked with."""
    n = len(elements)
    if not n:
        return np.zeros(0, np.uint64)
    starts = band_starts()
    first, last = np.searchsorted(starts, [n, n * 100 // percent], side="right") - 1
    values = mixed(elements ^ np.uint64(_ODD[0]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    found = []
    for band in range(int(first), int(last) + 1):
        tolerant, exact, left_out = allocation(band, percent)
        m = tolerant + exact
        # Elements are sorted and uniform, so equal ranges of their values are the segments.
        segment = ((elements >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        edge = np.searchsorted(segment, np.arange(m + 1))
        total, count = sums[edge[1:]] - sums[edge[:-1]], np.diff(edge)
        name = mixed(np.arange(m, dtype=np.uint64) + np.uint64(band << 32))
        keys = mixed(total ^ name) + count.astype(np.uint64)
        if tolerant:
            at = segment.astype(np.int64)
            found.append(mixed((total[at] - values) ^ name[at]) + (count[at] - 1).astype(np.uint64))
        elif left_out:
            keys = keys[np.lexsort((keys, count))[left_out:]]
        found.append(keys)
    return np.unique(np.concatenate(found))


# --- links ----------------------------------------------------------------------------------


def linked_forest(sets: list[np.ndarray], sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect what all links of ``sets`` connect; only between sides if there are two."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    frequency = np.bincount(codes)
    order = np.argsort(codes, kind="stable")
    posting, begin = owner[order], np.concatenate([[0], np.cumsum(frequency)])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    two_sided = len(np.unique(sides)) > 1
    label, forest = np.arange(len(sets)), []
    for i in range(len(sets)):
        own = codes[bounds[i] : bounds[i + 1]]
        n = frequency[own]
        if not len(own) or n.max() < 2:
            continue
        place = np.repeat(begin[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(posting[place], minlength=len(sets))
        linked = 100 * common >= percent * (sizes[i] + sizes - common)
        linked[: i + 1] = False
        if two_sided:
            linked &= sides != sides[i]
        for j in np.flatnonzero(linked & (label != label[i])):
            if label[j] != label[i]:
                forest.append((i, int(j)))
                label[label == label[j]] = label[i]
    return forest


def signature(elements: np.ndarray) -> np.ndarray:
    """How many elements lie in each of a power of two of equal parts, some four in each."""
    if len(elements) < LEAST_SIGNED:
        return np.zeros(0, np.uint8)
    bits = len(elements).bit_length() - 3
    counts = np.bincount((elements >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, MOST_COUNTED).astype(np.uint8)


def _fold(signs: np.ndarray) -> np.ndarray:
    """Signatures with half as many parts."""
    return np.minimum(signs[:, ::2] + signs[:, 1::2], MOST_COUNTED)


def near_forest(sizes: np.ndarray, signatures: list[np.ndarray], sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs that connect what all pairs connect that may be linked, by sizes and signatures."""
    two_sided = len(np.unique(sides)) > 1
    label, forest = np.arange(len(sizes)), []
    by_parts = {parts: np.flatnonzero([len(s) == parts for s in signatures]) for parts in {len(s) for s in signatures} - {0}}
    for parts, own in sorted(by_parts.items()):
        signs = np.stack([signatures[i] for i in own]).astype(np.int16)
        others = [(own, signs)]
        if 2 * parts in by_parts:
            finer = by_parts[2 * parts]
            others.append((finer, _fold(np.stack([signatures[i] for i in finer]).astype(np.int16))))
        for right, right_signs in others:
            order = np.argsort(sizes[right], kind="stable")
            right, right_signs = right[order], right_signs[order]
            for row, i in enumerate(own):
                # Linked sets have at least this share of the other's elements.
                first, last = np.searchsorted(sizes[right], [-(-sizes[i] * percent // 100), sizes[i] * 100 // percent + 1])
                some = right[first:last]
                chosen = (label[some] != label[i]) & (some > i if right is own else True)
                if two_sided:
                    chosen &= sides[some] != sides[i]
                if not chosen.any():
                    continue
                apart = np.abs(right_signs[first:last][chosen] - signs[row]).sum(1)
                some = some[chosen]
                # Links of sizes a and b have c >= percent (a + b) / (100 + percent) in common.
                may = (100 + percent) * apart <= (100 - percent) * (sizes[some] + sizes[i])
                for j in some[may]:
                    if label[j] != label[i]:
                        forest.append((int(i), int(j)))
                        label[label == label[j]] = label[i]
    return forest


def _rows(texts: DataFrame, make, schema: str, arrow: pa.Schema) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(make(batches), arrow, size=lambda r: 8 * len(r[-1] or b""))

    return texts.mapInArrow(run, schema)


def _key_batch(held: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    """Documents with their sizes and lists of keys, without a Python number for each key."""
    ids, sizes, keys = zip(*held)
    ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys).view(np.int64)))
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), lists], names=["id", "n", "keys"])


def jaccard_groups(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                   text_col: str = "text", screened: bool = True) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: set size, least id reachable by links.

    Documents are linked if ``100 * common >= percent * union`` of their sets of ``width``-word
    runs. Empty and null texts have no set and are linked with nothing. Equal sets are linked, so
    copies share a component however many there are. Rows that repeat an id count as one document
    in links and get a result each; rows with a null id get a null component. An empty table gives
    an empty result. ``screened`` rules pairs out by signatures first, which pays at thresholds as
    low as 80; from 85 on, segments are so large that few sets share a key by chance.
    """
    spark = docs.sparkSession
    root = shared_dir(spark, "jaccard")
    texts = texts_of(docs, id_col, text_col)

    def numbered(batches):
        words = _Words()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield doc, shingles(text.as_py(), width, words)

    def sizes(batches):
        for doc, found in numbered(batches):
            digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
            yield doc, len(found), digest, signature(found).tobytes() if screened else b""

    def keys(batches):
        seen, held, total = set(), [], 0  # a copy's keys are those of the copy before it in this task
        for doc, found in numbered(batches):
            digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            if doc is None or not len(found) or digest in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(digest)
            held.append((doc, len(found), keys_of(found, percent)))
            total += len(held[-1][2])
            if total >= KEYS:
                yield _key_batch(held)
                held, total = [], 0
        if held:
            yield _key_batch(held)

    size_schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary())])
    with rows_per_batch(spark):
        _rows(texts, sizes, "id bigint, n bigint, digest binary, signature binary", size_schema).write.parquet(f"{root}/sizes")
    measured = spark.read.parquet(f"{root}/sizes")

    keyed = texts.mapInArrow(keys, "id bigint, n bigint, keys array<bigint>")
    by_key = Window.partitionBy("key").orderBy("id")
    shared = (
        keyed.select(F.explode("keys").alias("key"), "id", "n")
        .withColumns({
            "least": F.first("id").over(by_key), "next": F.lead("id").over(by_key),
            "smallest": F.min("n").over(Window.partitionBy("key")),
        })
        .where("id <> least OR next <> id").select("key", "id", "n", "least", "smallest")
    )
    with rows_per_batch(spark):
        shared.write.parquet(f"{root}/shared")
    candidates, together = spark.read.parquet(f"{root}/shared"), F.min("least")
    if screened:
        # A group's documents are one block if there is room, so that few keys are in several blocks.
        candidates, together = _near(measured, candidates, root, percent), F.min("label")
    links = _links(texts, candidates, together, f"{root}/exact", numbered, percent)

    # Copies collapse to their least id before links are followed.
    least = measured.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("least"))
    least.write.parquet(f"{root}/least")
    copies = spark.read.parquet(f"{root}/least")
    member = measured.where("id IS NOT NULL").join(copies, "digest").select("id", "least").where("id <> least")
    labels = components(links.unionByName(member.select(F.col("id").alias("a"), F.col("least").alias("b"))))
    return measured.join(labels, measured["id"] == labels["node"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("label", "id").alias("component_id")
    )


def _near(measured: DataFrame, shared: DataFrame, root: str, percent: int) -> DataFrame:
    """The rows of ``shared`` that are left when documents share keys only within their groups.

    Groups connect all pairs that signatures do not rule out. Documents too small for a signature
    are grouped with all that they share a key with.
    """
    spark = shared.sparkSession
    seated = _seats(shared, f"{root}/coarse", F.min("least"), SIGNED_BLOCK)
    signed = measured.where(F.length("signature") > 0).select("id", "n", "signature")
    placed = signed.join(seated, "id").select(F.explode("cells").alias("cell"), "id", "n", "block", "signature")

    def compare(table: pa.Table) -> pa.Table:
        ids, names = table["id"].to_pylist(), table["block"].to_pylist()
        signatures = [np.frombuffer(e, np.uint8) for e in table["signature"].to_pylist()]
        sides = np.array([name == names[0] for name in names])
        return _ends(ids, near_forest(table["n"].to_numpy(), signatures, sides, percent))

    pairs = placed.groupBy("cell").applyInArrow(compare, "a bigint, b bigint")
    small = shared.where((F.col("smallest") < LEAST_SIGNED) & (F.col("id") != F.col("least"))).select(
        F.col("id").alias("a"), F.col("least").alias("b")
    )
    pairs.unionByName(small.distinct()).write.parquet(f"{root}/pairs")
    groups = components(spark.read.parquet(f"{root}/pairs"))
    by_key = Window.partitionBy("key", "label").orderBy("id")
    left = (
        shared.drop("least", "smallest").join(groups, F.col("id") == F.col("node"))
        .withColumns({"least": F.first("id").over(by_key), "next": F.lead("id").over(by_key)})
        .where("id <> least OR next <> id").select("key", "id", "n", "least", "label")
    )
    # Keys of different groups are different keys.
    left.withColumn("key", F.xxhash64("key", "label")).write.parquet(f"{root}/near")
    return spark.read.parquet(f"{root}/near")


def _ends(ids: list[int], forest: list[tuple[int, int]]) -> pa.Table:
    ends = [[ids[pair[end]] for pair in forest] for end in (0, 1)]
    return pa.table([pa.array(e, pa.int64()) for e in ends], names=["a", "b"])


def _seats(shared: DataFrame, root: str, together: Column, most: int) -> DataFrame:
    """``id, block, cells`` of documents with shared keys: the block of each, and where to compare it.

    Documents with the same ``together`` are in one block, or in several if they have more than
    ``most`` elements.
    """
    spark = shared.sparkSession
    near = shared.groupBy("id").agg(together.alias("near"), F.max("n").alias("n"))
    parts = near.groupBy("near").agg(F.ceil(F.sum("n") / most).alias("parts"))
    placed = near.join(parts, "near").select(
        "id", F.concat_ws(".", "near", F.pmod(F.xxhash64("id"), "parts")).alias("block")
    )
    placed.write.parquet(f"{root}/blocks")
    blocks = spark.read.parquet(f"{root}/blocks")
    shared.select("key", "id").join(blocks, "id").write.parquet(f"{root}/placed")
    by_key = spark.read.parquet(f"{root}/placed")
    # A document goes to the cell of its block and, for each key that is in other blocks too, to
    # the cells of those pairs of blocks.
    others = by_key.select("key", F.col("block").alias("other")).distinct()
    across = by_key.join(others, "key").where("block <> other").select(
        "id", F.concat_ws("/", F.least("block", "other"), F.greatest("block", "other")).alias("cell")
    ).distinct()
    within = blocks.join(blocks.groupBy("block").count().where("count > 1"), "block").select(
        "id", F.concat_ws("/", "block", "block").alias("cell")
    )
    seats = across.unionByName(within).groupBy("id").agg(F.collect_list("cell").alias("cells"))
    seats.join(blocks, "id").write.parquet(f"{root}/seats")
    return spark.read.parquet(f"{root}/seats")


def _links(texts: DataFrame, shared: DataFrame, together: Column, root: str, numbered, percent: int) -> DataFrame:
    """``a, b``: links that connect all documents that links connect, among those with shared keys."""
    spark, seated = texts.sparkSession, _seats(shared, root, together, BLOCK)
    wanted = texts.join(seated.hint("shuffle_hash"), "id").select("id", "text", "block", "cells")
    schema = pa.schema([("cell", pa.string()), ("id", pa.int64()), ("block", pa.string()), ("elements", pa.binary())])

    def sets(batches):
        def rows():
            for batch in batches:
                more = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
                for (doc, found), (block, cells) in zip(numbered([batch]), more):
                    for cell in cells:
                        yield cell, doc, block, found.tobytes()

        yield from batched(rows(), schema, size=lambda r: len(r[3]))

    gathered = wanted.mapInArrow(sets, "cell string, id bigint, block string, elements binary")

    def compare(table: pa.Table) -> pa.Table:
        ids, names = table["id"].to_pylist(), table["block"].to_pylist()
        found = [np.frombuffer(e, np.uint64) for e in table["elements"].to_pylist()]
        sides = np.array([name == names[0] for name in names])
        return _ends(ids, linked_forest(found, sides, percent))

    links = gathered.groupBy("cell").applyInArrow(compare, "a bigint, b bigint")
    with rows_per_batch(spark):
        links.write.parquet(f"{root}/links")
    return spark.read.parquet(f"{root}/links")


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` with only the document of the least id of each component, and those with a null id."""
    groups = jaccard_groups(docs, width, percent, id_col, text_col)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    at = f"{shared_dir(docs.sparkSession, 'jaccard')}/gone"
    gone.write.parquet(at)
    dropped = docs.sparkSession.read.parquet(at)
    return docs.join(dropped, docs[id_col] == dropped["_gone"], "left_anti")
