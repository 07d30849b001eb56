"""Phrases whose words keep together, mined by counting tiles of pairs of frequency-ranked ids.

Words are numbered by frequency, so a pair of ids is a cell of a square whose corner is dense. That
corner is split into tiles; a tile with many pairs in a task is counted with a dense ``bincount``,
the sparse rest as sorted coordinates with counts. The most frequent pairs are numbered by
frequency again, and two of them that overlap are a phrase of one word more: a cell of the next
square, which is counted by the same step, and so on until phrases are long enough.

A phrase can only be frequent if the phrases of one word less in it are. What every task knows of
those is a bitmap of fixed size, and the numbers of at most ``RANKED`` of them; a phrase that the
bitmap lets through by chance is counted and found rare, so nothing is lost and nothing is wrong.
Texts become blocks of ids once, bounded in size and stored; a block is sent the ids of its own
words. Counts of a phrase meet by the phrase, summed per task before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnout.llm.jaccard import mixed
from turnout.llm.tokens import batched
from turnout.operators import numbered
from turnout.sinks import shared_dir

#: Tokens in a task's blocks; bytes of text split at once; phrases that a task holds before it sends
#: them; tokens looked at together; phrases that are numbered again.
BLOCK_TOKENS, PART_BYTES, HELD, TOGETHER, RANKED = 1 << 23, 1 << 20, 1 << 22, 1 << 20, 1 << 20
#: Side of a tile, tiles along a side of the corner, and pairs that make a tile dense.
SIDE, TILES, DENSE = 1 << 10, 16, 1 << 15
#: Bits of the bitmap, and in one of its rows.
BITS, ROW_BITS = 1 << 26, 1 << 18
#: Rows that travel together; words of blocks that are looked up together.
ROWS, LOOKED_UP = 1 << 16, 1 << 18

# What ends a piece of text, and A-Z lower-cased.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Never part of UTF-8, so free to mark the end of a piece.
_END = 0xFF
_LOW = (1 << 32) - 1
_TABLE = bytes(_END if b in _ENDS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

_BLOCK = "lang string, block bigint, n bigint, size bigint, words binary, counts binary, ids binary"
_ARROW_BLOCK = pa.schema([
    ("lang", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("words", pa.binary()),
    ("counts", pa.binary()), ("ids", pa.binary()),
])
_ARROW_WORD = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])
#: Words of one range of hashes, joined by spaces, with their places in a block or their ids.
_PACKED = "part int, block bigint, lang string, words binary, numbers binary"
_ARROW_PACKED = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("numbers", pa.binary())
])
_NAMES = "block bigint, places binary, ids binary"
_ARROW_NAMES = pa.schema([("block", pa.int64()), ("places", pa.binary()), ("ids", pa.binary())])


# --- blocks of ids --------------------------------------------------------------------------


class _Block(dict):
    """The words of a block, numbered from 1, and its ids; 0 stands between pieces of text."""

    def __init__(self):
        self.ids, self.size = [np.zeros(1, "<u4")], 1
        self[bytes([_END])] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def add(self, text: str) -> None:
        data = text.encode().translate(_TABLE)
        start = 0
        while start < len(data):
            end = data.find(b" ", start + PART_BYTES)
            end = len(data) if end < 0 else end
            words = data[start:end].replace(b"\xff", b" \xff ").split()
            self.ids.append(np.fromiter(map(self.__getitem__, words), "<u4", len(words)))
            self.size += len(words)
            start = end
        self.ids.append(np.zeros(1, "<u4"))
        self.size += 1

    def row(self, lang: str, block: int) -> tuple:
        ids = np.concatenate(self.ids)
        counts = np.bincount(ids, minlength=len(self))[1:]
        words = b" ".join(word for word, number in self.items() if number)
        return lang, block, int(counts.sum()), len(counts), words, counts.astype("<u4").tobytes(), ids.tobytes()


def _blocks(batches) -> Iterator[tuple]:
    block, held, size = TaskContext.get().partitionId() << 32, {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = held.setdefault(lang, _Block())
            size -= own.size
            own.add(text.as_py())
            size += own.size
            if size >= BLOCK_TOKENS:
                for lang, own in held.items():
                    yield own.row(lang, block)
                    block += 1
                held, size = {}, 0
    for lang, own in held.items():
        yield own.row(lang, block)
        block += 1


def _words(row: dict) -> list[bytes]:
    return row["words"].split(b" ") if row["words"] else []


# --- counting -------------------------------------------------------------------------------


def counted_pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of ids as ``first << 32 | second``, in no order, and how often each occurs."""
    corner = (first < SIDE * TILES) & (second < SIDE * TILES)
    tile = (first[corner] // SIDE * TILES + second[corner] // SIDE).astype(np.uint16)
    sizes = np.bincount(tile, minlength=TILES * TILES)
    dense = np.flatnonzero(sizes >= DENSE)
    chosen = (sizes >= DENSE)[tile]
    in_dense = np.zeros(len(first), bool)
    in_dense[corner] = chosen
    pairs, counts = [], []
    order = np.argsort(tile[chosen], kind="stable")
    x, y, ends = first[in_dense][order], second[in_dense][order], np.cumsum(sizes[dense])
    for number, begin, end in zip(dense, ends - sizes[dense], ends):
        left, right = int(number) // TILES * SIDE, int(number) % TILES * SIDE
        cells = np.bincount((x[begin:end] - left) * SIDE + (y[begin:end] - right), minlength=SIDE * SIDE)
        seen = np.flatnonzero(cells)
        pairs.append((seen // SIDE + left) << 32 | (seen % SIDE + right))
        counts.append(cells[seen])
    seen, n = np.unique(first[~in_dense] << 32 | second[~in_dense], return_counts=True)
    return np.concatenate([*pairs, seen]), np.concatenate([*counts, n])


@dataclass
class Frequent:
    """What tasks know of the frequent phrases of one length: a bitmap of all, numbers of some.

    A phrase of up to four words is two 64-bit halves of two ids each, 0 where it has no word.
    """

    bitmap: np.ndarray
    heads: np.ndarray
    tails: np.ndarray
    numbers: np.ndarray

    def has(self, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
        at = _bit(heads, tails).astype(np.int64)
        return (self.bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1

    def number(self, heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """From 1; 0 for phrases that have none."""
        if not len(self.numbers):
            return np.zeros(len(heads), np.int64)
        # Numbered phrases lie by their first half, then by their second.
        key, own = _mark(heads, tails), _mark(self.heads, self.tails)
        at = np.minimum(np.searchsorted(own, key), len(own) - 1)
        same = (self.heads[at] == heads) & (self.tails[at] == tails)
        return np.where(same, self.numbers[at], 0)


def _mark(heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    return mixed(heads.view(np.uint64) + mixed(tails.view(np.uint64) + np.uint64(1)))


def _bit(heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    return _mark(heads, tails) & np.uint64(BITS - 1)


def _halves(ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrase of ``length`` words that begins at each place, as its two halves."""
    n = len(ids) - length + 1
    word = [ids[i : i + n] if i < length else np.zeros(n, np.int64) for i in range(4)]
    return word[0] << 32 | word[1], word[2] << 32 | word[3]


def counted_phrases(ids: np.ndarray, length: int, known: Frequent | None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Phrases of ``length`` words whose two parts may be frequent: halves and counts, in no order."""
    none = np.zeros(0, np.int64)
    if len(ids) < length:
        return none, none if length > 2 else None, none
    if length == 2:
        pairs, counts = counted_pairs(*(part[(ids[:-1] > 0) & (ids[1:] > 0)] for part in (ids[:-1], ids[1:])))
        return pairs, None, counts
    heads, tails = _halves(ids, length - 1)
    whole = np.ones(len(heads), bool)
    for i in range(length - 1):
        whole &= ids[i : i + len(heads)] > 0
    whole[whole] = known.has(heads[whole], tails[whole])
    at = np.flatnonzero(whole[:-1] & whole[1:])
    heads, tails = _halves(ids, length)
    # Two numbered parts are a cell; others are coordinates as they are.
    numbered_parts = np.zeros(len(whole), np.int64)
    part_heads, part_tails = _halves(ids, length - 1)
    parts = np.flatnonzero(whole)
    numbered_parts[parts] = known.number(part_heads[parts], part_tails[parts])
    first, second = numbered_parts[at], numbered_parts[at + 1]
    cells = (first > 0) & (second > 0)
    pairs, counts = counted_pairs(first[cells], second[cells])
    by_number = np.argsort(known.numbers)
    left, right = by_number[(pairs >> 32) - 1], by_number[(pairs & 0xFFFFFFFF) - 1]
    cell_heads, cell_tails = _joined(known.heads[left], known.tails[left], known.heads[right], known.tails[right], length)
    rest = at[~cells]
    rest_heads, rest_tails, rest_counts = _merged([(heads[rest], tails[rest], np.ones(len(rest), np.int64))])
    return np.concatenate([cell_heads, rest_heads]), np.concatenate([cell_tails, rest_tails]), np.concatenate([counts, rest_counts])


def _joined(left_heads, left_tails, right_heads, right_tails, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrase of which two phrases of one word less are the beginning and the end."""
    low = np.int64(0xFFFFFFFF)
    if length == 3:
        return left_heads, (right_heads & low) << 32
    return left_heads, left_tails | right_tails >> 32


def _merged(held: list[tuple[np.ndarray, np.ndarray | None, np.ndarray]]) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Sorted distinct phrases with their summed counts; those of two words have no second half."""
    heads, counts = (np.concatenate([part[i] for part in held]) for i in (0, 2))
    tails = None if held[0][1] is None else np.concatenate([part[1] for part in held])
    if not len(heads):
        return heads, tails, counts
    order = np.argsort(heads, kind="stable") if tails is None else np.lexsort((tails, heads))
    heads, counts = heads[order], counts[order]
    fresh = heads[1:] != heads[:-1]
    if tails is not None:
        tails = tails[order]
        fresh |= tails[1:] != tails[:-1]
    begin = np.flatnonzero(np.concatenate([[True], fresh]))
    return heads[begin], None if tails is None else tails[begin], np.add.reduceat(counts, begin)


def _phrase_rows(batches, length: int, known: Frequent | None) -> Iterator[pa.RecordBatch]:
    """Phrases of a task's blocks with their counts, summed over as many as may be held."""
    held: list[tuple[np.ndarray, np.ndarray | None, np.ndarray]] = []

    def sent() -> Iterator[pa.RecordBatch]:
        heads, tails, counts = _merged(held)
        held.clear()
        for a in range(0, len(heads), ROWS):
            own = heads[a : a + ROWS]
            tail = np.zeros(len(own), np.int64) if tails is None else tails[a : a + ROWS]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (own, tail, counts[a : a + ROWS])], names=["head", "tail", "n"])

    for batch in batches:
        for packed in batch.column(0):
            ids = np.frombuffer(packed.as_py(), "<u4")
            for a in range(0, max(1, len(ids) - 1), TOGETHER):
                # Parts overlap so that each phrase begins in one of them.
                part = ids[a : a + TOGETHER + length - 1].astype(np.int64)
                held.append(counted_phrases(part, length, known))
                if len(held) > 1 and sum(len(h[0]) for h in held) >= HELD:
                    held[:] = [_merged(held)]
                    if len(held[0][0]) >= HELD // 2:
                        yield from sent()
    if held:
        yield from sent()


# --- what a block needs of a dictionary -----------------------------------------------------


def _word_bits(langs: list[str], words: list[bytes]) -> np.ndarray:
    keys = [xxhash.xxh3_64_intdigest(word, seed=xxhash.xxh32_intdigest(lang.encode())) for lang, word in zip(langs, words)]
    return np.array(keys, np.uint64) & np.uint64(BITS - 1)


def _bitmap(keys: DataFrame, of) -> np.ndarray:
    """Bits of all keys; ``of`` gives those of a batch. The driver gets ``BITS`` bits at most."""

    def places(batches):
        for batch in batches:
            bits = np.unique(of(batch))
            yield pa.record_batch([pa.array(bits // ROW_BITS, pa.int32()), pa.array(bits % ROW_BITS, pa.int32())], names=["row", "bit"])

    def row(table: pa.Table) -> pa.Table:
        bits = np.zeros(ROW_BITS, bool)
        bits[table["bit"].to_numpy()] = True
        return pa.table({"row": table["row"][:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    rows = keys.mapInArrow(places, "row int, bit int").distinct().groupBy("row").applyInArrow(row, "row int, bits binary")
    bitmap = np.zeros(BITS // 8, np.uint8)
    for number, bits in rows.toLocalIterator():
        bitmap[number * ROW_BITS // 8 : (number + 1) * ROW_BITS // 8] = np.frombuffer(bits, np.uint8)
    return bitmap


def _packed(block: int | None, lang: str, words: list[bytes], numbers: np.ndarray, bits: np.ndarray, parts: int) -> Iterator[tuple]:
    """Rows of words with their numbers, one for each range of hashes that has some."""
    part = bits.astype(np.int64) * parts // BITS
    order = np.argsort(part, kind="stable")
    begin = np.flatnonzero(np.diff(part[order], prepend=-1))
    for a, b in zip(begin, [*begin[1:], len(order)]):
        some = order[a:b]
        yield int(part[some[0]]), block, lang, b" ".join([words[i] for i in some]), numbers[some].astype("<u4").tobytes()


def _looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
    """Ids of the words that blocks ask for, within one range of hashes."""
    ids: dict[str, dict[bytes, int]] = {}
    for lang, words, numbers in zip(*(right[name].to_pylist() for name in ("lang", "words", "numbers"))):
        ids.setdefault(lang, {}).update(zip(words.split(b" "), np.frombuffer(numbers, "<u4").tolist()))
    rows = []
    for block, lang, words, numbers in zip(*(left[name].to_pylist() for name in ("block", "lang", "words", "numbers"))):
        known = ids.get(lang, {})
        found = np.array([known.get(word, 0) for word in words.split(b" ")], "<u4")
        rows.append((block, np.frombuffer(numbers, "<u4")[found > 0].tobytes(), found[found > 0].tobytes()))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, _ARROW_NAMES)], schema=_ARROW_NAMES)


def _renamed(blocks: DataFrame, names: DataFrame) -> DataFrame:
    """``ids`` of each block with new ids, 0 for words that have none."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        places, new = (np.frombuffer(b"".join(right[name].to_pylist()), "<u4") for name in ("places", "ids"))
        rows = []
        for packed in left["ids"].to_pylist():
            ids = np.frombuffer(packed, "<u4")
            table = np.zeros(int(max(ids.max(initial=0), places.max(initial=0))) + 1, "<u4")
            table[places] = new
            rows.append(table[ids].tobytes())
        return pa.table({"ids": pa.array(rows, pa.binary())})

    return blocks.groupBy("block").cogroup(names.groupBy("block")).applyInArrow(run, "ids binary")


# --- mining ---------------------------------------------------------------------------------


def _stored(df: DataFrame, at: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def _frequent_words(blocks: DataFrame, least: int, root: str) -> DataFrame:
    """``id, lang, word, a`` of the words that occur often enough, ids by frequency."""

    def words(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("lang", "words", "counts")}
                yield from batched(
                    ((row["lang"], word, n) for word, n in zip(_words(row), np.frombuffer(row["counts"], "<u4").tolist())), _ARROW_WORD
                )

    counted = blocks.select("lang", "words", "counts").mapInArrow(words, "lang string, word binary, n bigint")
    frequent = counted.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    return _stored(numbered(_stored(frequent, f"{root}/frequent-1"), [F.desc("a"), F.col("lang"), F.col("word")], "id"), f"{root}/dictionary-1")


def _first_ids(blocks: DataFrame, dictionary: DataFrame, root: str) -> DataFrame:
    """Each block with the ids of its frequent words, 0 for others."""

    of = lambda batch: _word_bits(batch.column(0).to_pylist(), batch.column(1).to_pylist())
    bitmap = blocks.sparkSession.sparkContext.broadcast(_bitmap(dictionary.select("lang", "word"), of))

    total = blocks.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // LOOKED_UP))

    def asked(batches):
        def rows():
            for batch in batches:
                for at in range(batch.num_rows):
                    row = {name: batch.column(name)[at].as_py() for name in ("lang", "block", "words")}
                    words = _words(row)
                    bits = _word_bits([row["lang"]] * len(words), words)
                    low = bits.astype(np.int64)
                    there = np.flatnonzero(bitmap.value[low >> 3] >> (7 - (low & 7)).astype(np.uint8) & 1)
                    yield from _packed(row["block"], row["lang"], [words[i] for i in there], there + 1, bits[there], parts)

        yield from batched(rows(), _ARROW_PACKED, size=lambda r: len(r[3]))

    def known(batches):
        def rows():
            for batch in batches:
                langs, words, ids = (batch.column(name).to_pylist() for name in ("lang", "word", "id"))
                for lang in sorted(set(langs)):
                    own = [i for i, other in enumerate(langs) if other == lang]
                    some = [words[i] for i in own]
                    yield from _packed(None, lang, some, np.array(ids)[own], _word_bits([lang] * len(some), some), parts)

        yield from batched(rows(), _ARROW_PACKED, size=lambda r: len(r[3]))

    needed = blocks.select("lang", "block", "words").mapInArrow(asked, _PACKED)
    entries = dictionary.select("lang", "word", "id").mapInArrow(known, _PACKED)
    names = needed.groupBy("part").cogroup(entries.groupBy("part")).applyInArrow(_looked_up, _NAMES)
    return _stored(_renamed(blocks.select("block", "ids"), names), f"{root}/ids")


def _frequent_phrases(ids: DataFrame, length: int, known, least: int, root: str) -> DataFrame:
    """``id, head, tail, a`` of the phrases that occur often enough, ids by frequency."""

    def count(batches):
        yield from _phrase_rows(batches, length, known.value if known else None)

    counted = ids.mapInArrow(count, "head bigint, tail bigint, n bigint")
    frequent = counted.groupBy("head", "tail").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    order = [F.desc("a"), F.col("head"), F.col("tail")]
    return _stored(numbered(_stored(frequent, f"{root}/frequent-{length}"), order, "id"), f"{root}/dictionary-{length}")


def _known(dictionary: DataFrame):
    """The bitmap of all phrases and the numbers of the first ``RANKED``, for every task."""
    of = lambda batch: _bit(batch.column(0).to_numpy(), batch.column(1).to_numpy())
    bitmap = _bitmap(dictionary.select("head", "tail"), of)
    ranked = dictionary.where(F.col("id") <= RANKED).select("head", "tail", "id").toArrow()
    heads, tails, numbers = (ranked[name].to_numpy() for name in ("head", "tail", "id"))
    order = np.argsort(_mark(heads, tails))
    return dictionary.sparkSession.sparkContext.broadcast(Frequent(bitmap, heads[order], tails[order], numbers[order]))


def _spelled(phrases: DataFrame, parts: DataFrame, length: int) -> DataFrame:
    """Phrases with their two overlapping parts and the counts of all their beginnings and ends."""
    word = [F.shiftrightunsigned("head", 32), F.col("head").bitwiseAND(F.lit(_LOW)),
            F.shiftrightunsigned("tail", 32), F.col("tail").bitwiseAND(F.lit(_LOW))]
    none = F.lit(0).cast("bigint")

    def half(words: list[Column]) -> Column:
        return F.shiftleft(words[0], 32).bitwiseOR(words[1])

    def part(words: list[Column], side: str) -> list[Column]:
        # A part of one word is that word's id.
        padded = [none, words[0], none, none] if length == 2 else [*words, *[none] * (4 - len(words))]
        return [half(padded[:2]).alias(f"{side}_head"), half(padded[2:]).alias(f"{side}_tail")]

    split = phrases.select("*", *part(word[: length - 1], "left"), *part(word[1:length], "right"))
    left = parts.select(F.col("head").alias("left_head"), F.col("tail").alias("left_tail"), "lang", "words", "starts")
    right = parts.select(F.col("head").alias("right_head"), F.col("tail").alias("right_tail"), F.element_at("words", -1).alias("last"), "ends")
    joined = split.join(left, ["left_head", "left_tail"]).join(right, ["right_head", "right_tail"])
    return joined.select(
        "head", "tail", "lang", "a", "left_head", "left_tail", "right_head", "right_tail",
        F.array_append("words", F.col("last")).alias("words"),
        F.array_append("starts", F.col("a")).alias("starts"), F.array_append("ends", F.col("a")).alias("ends"),
    )


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, k: int = 2000, covered_percent: int = 80,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``k`` best phrases of several words.

    A candidate has 2 to ``longest`` words within a piece of text and occurs ``a >= least`` times. Its
    score is that of its lowest-scoring cut in two, ``2000000 * a`` by the sum of what the two parts
    occur, rounded down. A candidate goes if a longer one holds it and occurs at least
    ``covered_percent`` as often: it suffices to look at those of one word more, which occur no less
    than longer ones. ``n`` counts the language's words. Order: score and ``a`` descending, then the
    phrase by its bytes. ``longest`` is at most 4.

    A null text is empty; a null language is ``und``. Every row counts, also repeated ones and those
    without an id. Whole texts count, however long. Languages without a frequent phrase, and empty
    tables, give no rows. Other columns are not read.
    """
    if not 2 <= longest <= 4:
        raise ValueError(f"phrases have 2 to 4 words: {longest}")
    root = shared_dir(docs.sparkSession, "collocations")
    texts = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    to_blocks = lambda batches: batched(_blocks(batches), _ARROW_BLOCK, most=1)
    blocks = _stored(texts.mapInArrow(to_blocks, _BLOCK), f"{root}/blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    words = _frequent_words(blocks, least, root)
    ids = _first_ids(blocks, words, root)
    own, none = F.array("a"), F.lit(0).cast("bigint")
    # A phrase is told by its ids, two in each half; a word by its own.
    phrases = words.select(
        F.col("id").alias("head"), none.alias("tail"), "lang", F.array(F.col("word").cast("string")).alias("words"),
        own.alias("starts"), own.alias("ends"),
    )
    candidates, known = [], None
    for length in range(2, longest + 1):
        dictionary = _frequent_phrases(ids, length, known, least, root)
        longer = _stored(_spelled(dictionary.select("head", "tail", "a"), phrases, length), f"{root}/phrases-{length}")
        if length > 2:
            candidates[-1] = _uncovered(candidates[-1], longer, covered_percent)
        candidates.append(longer)
        if length < longest:
            known = _known(dictionary)
        phrases = longer
    return _ranked(reduce(DataFrame.unionByName, candidates), totals, k)


def _uncovered(candidates: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """Without those that a phrase of one word more holds and that seldom occur without it."""
    sides = [
        longer.select(F.col(f"{side}_head").alias("in_head"), F.col(f"{side}_tail").alias("in_tail"), F.col("a").alias("covering"))
        for side in ("left", "right")
    ]
    most = sides[0].unionByName(sides[1]).groupBy("in_head", "in_tail").agg(F.max("covering").alias("covering"))
    same = (candidates["head"] == most["in_head"]) & (candidates["tail"] == most["in_tail"])
    covered = candidates.join(most, same, "left")
    return covered.where(F.col("covering").isNull() | (100 * F.col("covering") < percent * F.col("a"))).select(*candidates.columns)


def _ranked(candidates: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    # 2000000 * a may pass 64 bits, so it is a decimal.
    cuts = F.expr("""transform(sequence(1, size(words) - 1), cut -> named_struct(
        'score', (cast(a AS decimal(20, 0)) * 2000000BD) div (starts[cut - 1] + ends[size(words) - cut - 1]),
        'cut', cut, 'l', starts[cut - 1], 'r', ends[size(words) - cut - 1]))""")
    scored = candidates.select("lang", F.array_join("words", " ").alias("phrase"), "a", F.array_min(cuts).alias("least")).select(
        "lang", "phrase", "a", F.col("least.l").alias("l"), F.col("least.r").alias("r"), F.col("least.score").alias("score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
