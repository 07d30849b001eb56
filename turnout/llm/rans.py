"""Token ids in files: interleaved range asymmetric numeral systems over one static table.

A file holds sections of whole documents in ascending order of their ids. A section's token ids
are cut into blocks. Each block is coded by itself in ``lanes`` interleaved states, all by the
frequencies of the whole corpus, which are stored once. For each block the section keeps a
checkpoint (the states to start from and the offset of the block's words) and a checksum, so any
block can be decoded alone, and all blocks of a section are decoded side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnout.llm.tokens import batched, default_tokenizer, encoded, rows_per_batch, texts_of

#: Frequencies sum to 2**SCALE. States lie between 2**31 and 2**63 and give off 32 bits at a time.
SCALE, LOW = 20, np.uint64(1 << 31)
LANES, STEPS = 32, 256
#: A section is closed by the document that brings it to so many ids; blocks coded side by side.
SECTION_IDS, TOGETHER = 1 << 20, 64
#: Bytes of stretches whose ids a worker remembers.
REMEMBERED = 128 << 20

_HEAD = (
    "part int, section int, first_in_part bigint, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint"
)
_STAGED = f"{_HEAD}, tokens binary, counts binary, planes binary"
_SECTION = f"{_HEAD}, steps int, states binary, offsets binary, words binary, crcs binary"
_ARROW_HEAD = [
    ("part", pa.int32()), ("section", pa.int32()), ("first_in_part", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_ids", pa.int64()),
]
_ARROW_STAGED = pa.schema([*_ARROW_HEAD, ("tokens", pa.binary()), ("counts", pa.binary()), ("planes", pa.binary())])
_ARROW_SECTION = pa.schema([
    *_ARROW_HEAD, ("steps", pa.int32()), ("states", pa.binary()), ("offsets", pa.binary()),
    ("words", pa.binary()), ("crcs", pa.binary()),
])
_ARROW_DOC = pa.schema([
    ("part", pa.int32()), ("doc_id", pa.int64()), ("first_in_part", pa.int64()), ("n_tokens", pa.int64()),
    ("ids", pa.binary()),
])


# --- the code -------------------------------------------------------------------------------


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE and are at least 1 wherever the count is."""
    total = int(counts.sum())
    if not total:
        raise ValueError("no counts to scale")
    freq = np.where(counts > 0, np.maximum(1, counts * float(1 << SCALE) // total), 0).astype(np.int64)
    over = int(freq.sum()) - (1 << SCALE)
    for i in np.argsort(-freq, kind="stable"):
        if not over:
            break
        step = min(over, int(freq[i]) - 1) if over > 0 else over
        freq[i] -= step
        over -= step
    if over:
        raise ValueError("more symbols than 2**SCALE")
    return freq.astype(np.uint64)


class Table:
    """Frequencies, where each symbol's slots start, and the symbol of each slot."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.filler = int(freq.argmax())

    def slots(self) -> np.ndarray:
        """For each slot its symbol, the symbol's frequency less 1 and the slot's place in it."""
        n = self.freq.astype(np.int64)
        symbol = np.repeat(np.arange(len(n), dtype=np.uint64), n)
        place = np.arange(1 << SCALE, dtype=np.uint64) - np.repeat(self.start, n)
        width = np.uint64(SCALE)
        return (symbol << width | np.repeat(self.freq, n) - np.uint64(1)) << width | place


def encode_ids(ids: np.ndarray, table: Table) -> dict[str, object]:
    """Blocks of ``ids``, each coded by itself, some side by side."""
    steps = min(STEPS, -(-len(ids) // LANES))
    group = TOGETHER * steps * LANES
    parts = [_encode_group(ids[a : a + group], steps, table) for a in range(0, len(ids), group)]
    sizes = np.concatenate([part[1] for part in parts])
    return {
        "steps": steps,
        "states": b"".join(part[0] for part in parts),
        "offsets": np.concatenate([[0], np.cumsum(sizes)]).astype("<i8").tobytes(),
        "words": b"".join(part[2] for part in parts),
        "crcs": b"".join(part[3] for part in parts),
    }


def _encode_group(ids: np.ndarray, steps: int, table: Table) -> tuple[bytes, np.ndarray, bytes, bytes]:
    """States, numbers of words, words and checksums of a few blocks, last id first."""
    blocks = -(-len(ids) // (LANES * steps))
    padded = np.full(blocks * steps * LANES, table.filler, np.int64)
    padded[: len(ids)] = ids
    symbols = padded.reshape(blocks, steps, LANES).transpose(1, 0, 2).reshape(steps, -1)
    freqs, starts = table.freq[symbols], table.start[symbols]
    state = np.full(blocks * LANES, LOW, np.uint64)
    words = np.empty(symbols.shape, np.uint32)
    given = np.empty(symbols.shape, bool)
    for t in range(steps - 1, -1, -1):
        freq, start = freqs[t], starts[t]
        full = state >= freq << np.uint64(63 - SCALE)
        words[t] = state & np.uint64(0xFFFFFFFF)
        given[t] = full
        state = np.where(full, state >> np.uint64(32), state)
        whole = state // freq
        state = (whole << np.uint64(SCALE)) + (state - whole * freq) + start
    by_block = given.reshape(steps, blocks, LANES).transpose(1, 0, 2)
    out = words.reshape(steps, blocks, LANES).transpose(1, 0, 2)[by_block]
    sizes = by_block.sum(axis=(1, 2))
    crcs = [zlib.crc32(padded[i : i + steps * LANES].astype("<u4").tobytes())
            for i in range(0, len(padded), steps * LANES)]
    return state.astype("<u8").tobytes(), sizes, out.astype("<u4").tobytes(), np.array(crcs, "<u4").tobytes()


def decode_ids(coded: dict[str, object], n_ids: int, slots: np.ndarray) -> np.ndarray:
    """The ids of a section; raises if a block does not match its checksum."""
    steps = coded["steps"]
    states = np.frombuffer(coded["states"], "<u8").reshape(-1, LANES)
    words = np.append(np.frombuffer(coded["words"], "<u4"), np.uint32(0))
    offsets, crcs = np.frombuffer(coded["offsets"], "<i8")[:-1], np.frombuffer(coded["crcs"], "<u4")
    out = np.empty((len(states), steps * LANES), "<u4")
    for a in range(0, len(states), TOGETHER):
        part = slice(a, a + TOGETHER)
        out[part] = _decode_group(states[part], words, offsets[part], steps, slots)
        for block, crc in zip(out[part], crcs[part]):
            if zlib.crc32(block.tobytes()) != crc:
                raise ValueError("a block of token ids does not match its checksum")
    return out.reshape(-1)[:n_ids]


def _decode_group(states: np.ndarray, words: np.ndarray, offsets: np.ndarray, steps: int, slots: np.ndarray) -> np.ndarray:
    blocks, at = len(states), offsets.copy()
    state = states.reshape(-1).astype(np.uint64)
    out = np.empty((steps, blocks * LANES), np.uint32)
    mask, width = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for t in range(steps):
        found = slots[state & mask]
        out[t] = found >> width + width
        state = ((found >> width & mask) + np.uint64(1)) * (state >> width) + (found & mask)
        need = state < LOW
        taken = need.reshape(blocks, LANES).cumsum(axis=1)
        place = (at[:, None] + taken - 1).reshape(-1)
        refilled = np.flatnonzero(need)
        state[refilled] = state[refilled] << np.uint64(32) | words[place[refilled]]
        at += taken[:, -1]
    return out.reshape(steps, blocks, LANES).transpose(1, 0, 2).reshape(blocks, -1)


# --- files ----------------------------------------------------------------------------------


def _planes(ids: bytes) -> bytes:
    """The first bytes of all ids, then the second ones and so on, which compresses well."""
    return np.frombuffer(ids, np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _sections(documents: Iterator[tuple]) -> Iterator[tuple]:
    """Whole documents, in order, until they have enough ids."""
    part, section, first = TaskContext.get().partitionId(), 0, 0
    docs, lengths, held, n = [], [], [], 0
    for doc, ids in documents:
        docs.append(doc)
        lengths.append(len(ids) // 4)
        held.append(ids)
        n += lengths[-1]
        if n >= SECTION_IDS:
            yield part, section, first, docs, lengths, n, *_counted(b"".join(held))
            section, first = section + 1, first + n
            docs, lengths, held, n = [], [], [], 0
    if docs:
        yield part, section, first, docs, lengths, n, *_counted(b"".join(held))


def _counted(ids: bytes) -> tuple[bytes, bytes, bytes]:
    """Which ids there are, how often each, and all of them."""
    counts = np.bincount(np.frombuffer(ids, "<u4"))
    seen = np.flatnonzero(counts)
    return seen.astype("<u4").tobytes(), counts[seen].astype("<u4").tobytes(), _planes(ids)


def _id_counts(staged: DataFrame) -> np.ndarray:
    """How often each id occurs; at most one row per id of the vocabulary comes to the driver."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for tokens, counts in zip(batch.column(0), batch.column(1)):
                tokens, counts = (np.frombuffer(column.as_py(), "<u4") for column in (tokens, counts))
                if len(tokens) and tokens[-1] >= len(total):
                    total = np.append(total, np.zeros(int(tokens[-1]) + 1 - len(total), np.int64))
                total[tokens] += counts
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["token", "n"])

    counted = staged.select("tokens", "counts").mapInArrow(count, "token bigint, n bigint")
    rows = counted.groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.token for r in rows), default=-1) + 1, np.int64)
    for token, n in rows:
        counts[token] = n
    return counts


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str | None = None) -> None:
    """Encode every whole text and write the files under ``path``, in ascending order of ids.

    Files are numbered by ranges of ids, documents ascend within them (a null id first; rows that
    repeat an id by their texts), and each ends with the end id; a null text counts as empty. A
    document is never divided over sections, so one that is longer than a section makes a longer
    section. An empty table gives no sections.

    The table of frequencies needs the counts of all ids before the first is coded, so the ids
    are first stored plainly, beside ``path``.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()

    def stage(batches):
        yield from batched(_sections(encoded(batches, tokenizer, REMEMBERED)), _ARROW_STAGED, most=1)

    staged_at = f"{path}-staged"
    ordered = texts_of(docs, id_col, text_col).repartitionByRange("id").sortWithinPartitions("id", "text")
    with rows_per_batch(spark):
        ordered.mapInArrow(stage, _STAGED).write.option("compression", "zstd").parquet(staged_at)
    staged = spark.read.parquet(staged_at)
    counts = _id_counts(staged)
    freq = scaled(counts) if counts.any() else np.zeros(0, np.uint64)
    table = [(int(i), int(freq[i])) for i in np.flatnonzero(freq)]
    spark.createDataFrame(table, "token bigint, freq bigint").coalesce(1).write.parquet(f"{path}/table")

    def encode(batches):
        table = Table(freq) if len(freq) else None
        for batch in batches:
            for i in range(batch.num_rows):
                coded = encode_ids(_unplaned(batch.column("planes")[i].as_py()), table)
                head = [batch.column(name)[i].as_py() for name, _ in _ARROW_HEAD]
                yield from batched(iter([(*head, *coded.values())]), _ARROW_SECTION)

    coded = staged.drop("tokens", "counts").mapInArrow(encode, _SECTION)
    # A staged row is a whole section, so one at a time: otherwise a task's whole split comes at once.
    with rows_per_batch(spark, 1):
        coded.write.option("compression", "none").parquet(f"{path}/sections")
    sizes = spark.read.parquet(f"{path}/sections").groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per file.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    starts.write.parquet(f"{path}/starts")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, decoded from the files.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` counts the ids of all documents
    before it. Sections are decoded independently of each other.
    """
    table = spark.read.parquet(f"{path}/table").collect()  # one row per id of the vocabulary at most
    freq = np.zeros(max((r.token for r in table), default=0) + 1, np.uint64)
    for token, n in table:
        freq[token] = n

    def decode(batches):
        slots = Table(freq).slots() if freq.any() else freq
        rows = _documents(batches, slots)
        yield from batched(rows, _ARROW_DOC, size=lambda r: len(r[4]))

    docs = spark.read.parquet(f"{path}/sections").mapInArrow(
        decode, "part int, doc_id bigint, first_in_part bigint, n_tokens bigint, ids binary"
    )
    starts = spark.read.parquet(f"{path}/starts")
    return docs.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("first_in_part")).alias("start"), "n_tokens", "ids"
    )


def _documents(batches, slots: np.ndarray) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in _ARROW_SECTION.names}
            ids, at = decode_ids(row, row["n_ids"], slots), 0
            for doc, n in zip(row["doc_ids"], row["lengths"]):
                yield row["part"], doc, row["first_in_part"] + at, n, ids[at : at + n].tobytes()
                at += n
