"""Best-fit packing of documents into sequences of a fixed number of tokens.

Only lengths matter for where pieces go, and there are at most as many lengths as a sequence has
tokens. So the plan is made once, for the histogram of lengths: patterns of a few pieces that
fill a sequence are enumerated over length classes, non-negative least squares fits how often each
is used, the counts are rounded down, and what is left goes best-fit into the gaps and into new
sequences. The plan's size depends on the number of lengths, not of documents. Every piece then
finds its place from its length and its number among the pieces of that length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnout.llm.tokens import batched, default_tokenizer, encoded, rows_per_batch, texts_of
from turnout.sinks import shared_dir

#: Classes that lengths are rounded up to, and the most pieces in a pattern.
CLASSES, PATTERN_PIECES = 128, 3


# --- the plan -------------------------------------------------------------------------------


def patterns(classes: int, pieces: int) -> list[tuple[int, ...]]:
    """All ways to fill ``classes`` exactly with at most ``pieces`` parts, largest part first."""

    def fill(left: int, most: int, parts: int):
        if left == 0:
            yield ()
        elif parts:
            for part in range(min(left, most), -(-left // parts) - 1, -1):
                for rest in fill(left - part, part, parts - 1):
                    yield (part, *rest)

    return list(fill(classes, classes, pieces))


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The non-negative x that minimises ``|ax - b|``, by an active set."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0.0))
    for _ in range(3 * n):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        if passive.all() or gradient.max() <= tolerance:
            break
        passive[int(gradient.argmax())] = True
        while True:
            trial = np.zeros(n)
            trial[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            if trial[passive].min() > 0:
                x = trial
                break
            below = passive & (trial <= 0)
            step = (x[below] / np.maximum(x[below] - trial[below], 1e-300)).min()
            x = x + step * (trial - x)
            passive &= x > 1e-12
            x[~passive] = 0.0
            if not passive.any():
                break
    return x


@dataclass
class Plan:
    """Runs of pieces: those of one length whose numbers start at ``first``, ``per`` to a sequence.

    Sorted by length and number. ``sequences`` is how many sequences there are in all.
    """

    length: np.ndarray
    first: np.ndarray
    per: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces, by length and number among the pieces of that length."""
        key = np.int64(1) << np.int64(45)
        run = np.searchsorted(self.length * key + self.first, length * key + number, side="right") - 1
        within = number - self.first[run]
        per = self.per[run]
        return self.sequence[run] + within // per, self.offset[run] + within % per * length


class _Packer:
    def __init__(self, counts: dict[int, int], size: int):
        self.size = size
        self.left = {length: n for length, n in counts.items() if n}
        self.used: dict[int, int] = defaultdict(int)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.gaps: list[int] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def put(self, length: int, per: int, sequence: int, n: int, offset: int) -> None:
        """``per`` pieces of a length into each of ``n`` sequences."""
        self.runs.append((length, self.used[length], per, sequence, offset))
        self.used[length] += per * n
        self.left[length] -= per * n
        if not self.left[length]:
            del self.left[length]

    def add_open(self, gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if not self.open[gap]:
                bisect.insort(self.gaps, gap)
            self.open[gap].append((sequence, n))

    def take_open(self, at: int) -> tuple[int, int, int]:
        gap = self.gaps[at]
        sequence, n = self.open[gap].pop()
        if not self.open[gap]:
            del self.gaps[at]
        return gap, sequence, n

    def repeat(self, pattern: tuple[int, ...], times: int, members: dict[int, list[int]]) -> None:
        """Use a pattern ``times`` times, drawing the longest lengths of each class first."""
        done = 0
        while done < times:
            chosen: list[int] = []
            for part in pattern:
                spare = (x for x in members[part] if self.left.get(x, 0) > chosen.count(x))
                chosen.append(next(spare))
            n = min(times - done, *(self.left[x] // chosen.count(x) for x in set(chosen)))
            offset = 0
            for length in sorted(set(chosen), reverse=True):
                per = chosen.count(length)
                self.put(length, per, self.sequences, n, offset)
                offset += per * length
            self.add_open(self.size - offset, self.sequences, n)
            self.sequences += n
            done += n

    def fit_rest(self) -> None:
        """Longest first, each into the smallest gap that holds it, else into new sequences."""
        for length in sorted(self.left, reverse=True):
            while left := self.left.get(length, 0):
                at = bisect.bisect_left(self.gaps, length)
                if at < len(self.gaps):
                    gap, sequence, n = self.take_open(at)
                else:
                    per = self.size // length
                    gap, sequence, n = self.size, self.sequences, -(-left // per)
                    self.sequences += n
                per = min(gap // length, left)
                filled = min(n, left // per)
                self.put(length, per, sequence, filled, self.size - gap)
                self.add_open(gap - per * length, sequence, filled)
                self.add_open(gap, sequence + filled, n - filled)


def plan_packing(counts: dict[int, int], size: int = 4096) -> Plan:
    """Where ``counts[length]`` pieces of each length go; lengths are 1 to ``size``."""
    packer = _Packer(counts, size)
    width = max(1, size // CLASSES)
    members: dict[int, list[int]] = defaultdict(list)
    for length in sorted(packer.left, reverse=True):
        members[-(-length // width)].append(length)
    if packer.left:
        usable = [p for p in patterns(size // width, PATTERN_PIECES) if all(part in members for part in p)]
        parts = np.array(sorted(members), dtype=float)
        row = {int(part): i for i, part in enumerate(parts)}
        a = np.zeros((len(parts), len(usable)))
        for j, pattern in enumerate(usable):
            for part in pattern:
                a[row[part], j] += 1
        b = np.array([sum(packer.left[x] for x in members[int(part)]) for part in parts], float)
        # Short pieces fit in anywhere, so a miss counts by its length.
        weight = (parts / parts.max())[:, None]
        fitted = nnls(a * weight, b * weight[:, 0]) if usable else np.zeros(0)
        for j in np.argsort(-fitted, kind="stable"):
            have = {part: sum(packer.left.get(x, 0) for x in members[part]) for part in usable[j]}
            times = min(int(fitted[j] + 1e-6), *(have[p] // usable[j].count(p) for p in have))
            packer.repeat(usable[j], times, members)
        packer.fit_rest()
    runs = np.array(sorted(packer.runs), np.int64).reshape(-1, 5)
    return Plan(*runs.T, packer.sequences)


# --- the pieces -----------------------------------------------------------------------------

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, part int, nth bigint"
_ARROW_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64()),
])


def _pieces(documents: Iterator[tuple], size: int, with_ids: bool) -> Iterator[tuple]:
    part, seen = TaskContext.get().partitionId(), [0] * (size + 1)
    for doc, ids in documents:
        for piece, start in enumerate(range(0, len(ids), 4 * size)):
            own = ids[start : start + 4 * size]
            n = len(own) // 4
            yield doc, piece, start // 4, n, zlib.crc32(own), own if with_ids else None, part, seen[n]
            seen[n] += 1


def pack(docs: DataFrame, size: int = 4096, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset`` for every piece.

    Documents longer than ``size`` are cut into pieces of ``size`` and a rest; no other one is. A
    null text is an empty document, which still has its end id. Rows that repeat an id are packed
    each. An empty table packs to nothing. ``with_ids=False`` leaves ``ids`` null.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    root = shared_dir(spark, "packing")

    def cut(batches):
        rows = _pieces(encoded(batches, tokenizer), size, with_ids)
        yield from batched(rows, _ARROW_PIECE, size=lambda r: len(r[5] or b""))

    with rows_per_batch(spark):
        texts_of(docs, id_col, text_col).mapInArrow(cut, _PIECE).write.parquet(f"{root}/pieces")
    pieces = spark.read.parquet(f"{root}/pieces")
    # Numbers among the pieces of a length: those in earlier parts, then those earlier in the part.
    pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/counts")
    counts = spark.read.parquet(f"{root}/counts")
    earlier = F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    counts.select("part", "length", F.coalesce(earlier, F.lit(0)).alias("before")).write.parquet(f"{root}/before")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # a row per length at most
    plan = plan_packing({r.length: r.n for r in totals}, size)

    def place(batches):
        for batch in batches:
            length, nth, before = (batch.column(c).to_numpy() for c in ("length", "nth", "before"))
            sequence, offset = plan.place(length, nth + before)
            columns = [batch.column(i) for i in range(6)] + [pa.array(sequence), pa.array(offset)]
            names = [*_ARROW_PIECE.names[:6], "sequence_id", "offset"]
            yield pa.record_batch(columns, names=names)

    numbered = pieces.join(spark.read.parquet(f"{root}/before"), ["part", "length"])
    result = _PIECE.split(", part")[0] + ", sequence_id bigint, offset bigint"
    return numbered.select(*_ARROW_PIECE.names[:6], "nth", "before").mapInArrow(place, result)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token ids of each sequence, its pieces one after another."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
