"""Language-model scores: online logistic mixing of context bit predictors.

A text is a sequence of bytes and an end mark, each spelled as decisions along one binary code
tree (a Huffman tree of the training bytes). For each decision several predictors look up how the
training texts went on in their context: the last two or four bytes, or the word so far. A
logistic mixer weighs their opinions; its weights are chosen by how often the word so far was seen
and are learned online, and a last stage refines the mixed probability adaptively; both learn after
every ``TOGETHER`` decisions. Weights and refinement start afresh every ``SPAN`` bytes, so spans
are independent and run side by side.

The predictors are counts over all training texts. Those of the last bytes are tables of fixed size
with hashed rows. Those of the word so far are keyed rows whose number grows with the corpus, like
the count of every word for the plain base model beside it. Texts are stored in blocks of bounded
size, and each block is sent the counts of its own contexts and words. The word so far has a 64-bit
hash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout.llm.tokens import batched, rows_per_batch
from turnout.sinks import shared_dir

#: Lengths of the contexts of last bytes, the rows of the table of each, and where it begins.
ORDERS, SLOTS = (2, 4), (1 << 13, 1 << 15)
BEGIN = (0, SLOTS[0])
INPUTS = len(SLOTS) + 1
#: Never part of UTF-8, so free to mark the end.
END = 0xFF
#: Bytes scored with one set of weights; decisions between two updates; bytes of text in a block;
#: spans mixed side by side, and bytes of text looked at, scored or hashed together.
SPAN, TOGETHER, BLOCK_BYTES, LANES = 2048, 8, 1 << 23, 1 << 12
HELD_BYTES, SCORED_BYTES, HASHED_BYTES = 1 << 20, 3 << 20, 1 << 19
#: Decisions that are unpacked together, bytes that are spelled together, contexts whose counts and
#: stretches whose places are held at once.
AT_ONCE, SPELLED_BYTES, CONTEXTS_HELD, STRETCHES_HELD = 32, 1 << 13, 1 << 11, 1 << 14
#: What the mixer starts from: weights of the predictors by how often the word so far was seen, in
#: steps of ``LEVELS``. Fitted once by logistic regression on 70 documents of a small table.
LEVELS = (1, 2, 4, 8, 16, 64, 256)
START_WEIGHTS = (
    (0.86, 0.63, 0.0), (0.54, 0.51, 1.57), (0.49, 0.47, 0.98), (0.53, 0.33, 0.71),
    (0.47, 0.25, 0.66), (0.34, 0.2, 0.68), (0.22, 0.18, 0.72), (0.19, 0.62, 0.32),
)
RATE, REFINE_RATE, REFINE_BINS = 0.02, 0.02, 24
#: Stretched probabilities are kept in steps of 1/16 as far as +-8.
STEP, PRIOR = 16.0, 0.4

#: A byte that followed a context, and how often.
_NEXT = np.dtype([("byte", "u1"), ("n", "<i8")])
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTES = np.random.default_rng(0).integers(1, 1 << 63, 256, dtype=np.uint64)
#: White space and the end mark.
_CLOSES = np.isin(np.arange(256), [*range(9, 14), 32, END])


# --- contexts -------------------------------------------------------------------------------


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def table_rows(data: np.ndarray) -> np.ndarray:
    """Table row for each number of last bytes, before each byte of texts with end marks."""
    n, most = len(data), max(ORDERS)
    first = np.concatenate([[0], np.flatnonzero(data[:-1] == END) + 1])
    # The last four bytes as a number, the last of them lowest; before a text there are end marks.
    held = bytes([END] * most) + data.tobytes()
    run = np.ndarray(n, f">u{most}", held, strides=(1,)).astype(np.uint32)
    for age in range(most):
        at = first + age
        run[at[at < n]] |= np.uint32(0xFFFFFFFF << 8 * age & 0xFFFFFFFF)
    rows = np.empty((len(SLOTS), n), np.int32)
    for at, order in enumerate(ORDERS):
        last = run & np.uint32((1 << 8 * order) - 1)
        rows[at] = last * np.uint32(0x9E3779B1) >> np.uint32(33 - SLOTS[at].bit_length())
        rows[at] += BEGIN[at]
    return rows


def _summed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which stretches of bytes get their hashes, and what those that begin at each place
    are multiplied by."""
    n = len(data)
    size = 1 << max(14, n.bit_length())
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(_FACTOR, size)[:n], dtype=np.uint64, out=out[1:])
    return out, _powers(_INVERSE, size)


def _pieces(begin: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of stretches, by their ascending beginnings, that are hashed together."""
    at = 0
    while at < len(begin):
        until = int(np.searchsorted(begin, begin[at] + HASHED_BYTES))
        yield at, until
        at = until


def hashed(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each of some ascending stretches."""
    out = np.empty(len(begin), np.uint64)
    for a, b in _pieces(begin):
        summed, inverse = _summed(data[begin[a] : end[b - 1]])
        first = begin[a:b] - begin[a]
        out[a:b] = (summed[end[a:b] - begin[a]] - summed[first]) * inverse[first]
    return out


def word_keys(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of the bytes before each byte of its stretch; the stretches follow one another."""
    out = np.empty(len(data), np.uint64)
    for a, b in _pieces(begin):
        here = slice(begin[a], begin[b - 1] + sizes[b - 1])
        summed, inverse = _summed(data[here])
        first = np.repeat(begin[a:b] - begin[a], sizes[a:b])
        out[here] = (summed[:-1] - summed[first]) * inverse[first]
    return out


def contexts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table row for each number of last bytes, and key of the word so far, before each byte of
    texts with end marks."""
    begin = np.concatenate([[0], np.flatnonzero(_CLOSES[data[:-1]]) + 1])
    return table_rows(data), word_keys(data, begin, np.diff(begin, append=len(data)))


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key stands, in ascending order of keys, and each key's number among those.

    Numbers alone sort far faster than places by their numbers, so a place is sorted as the last bits
    of its key. Only if keys differ in nothing else than these are places sorted.
    """
    n = len(keys)
    keys = keys.view(np.uint64)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    place = np.arange(n, dtype=np.uint64)
    whole = n > 0 and int(keys.max()) >> (64 - int(bits)) == 0
    packed = (keys << bits if whole else keys >> bits << bits) | place
    packed.sort()
    at = (packed & np.uint64((1 << int(bits)) - 1)).astype(np.intp)
    own = keys[at]
    other = own[1:] != own[:-1]
    if not whole and (other & (packed[1:] >> bits == packed[:-1] >> bits)).any():
        at = np.argsort(keys, kind="stable")
        own = keys[at]
        other = own[1:] != own[:-1]
    number = np.empty(n, np.int32)
    number[at] = np.concatenate([np.zeros(min(n, 1), np.int32), np.cumsum(other, dtype=np.int32)])
    return at[np.concatenate([np.ones(min(n, 1), bool), other])], number


@dataclass
class Spelled:
    """Texts as stretches up to and with the white space or end mark that closes each.

    Texts repeat their words, and what comes before a byte since the last white space is the same
    wherever its stretch stands, so it is worked out once for each distinct stretch.
    """

    data: np.ndarray
    #: Where each text begins and the last ends in ``data``, and the same in ``which``.
    bounds: np.ndarray
    upto: np.ndarray
    #: Number of each stretch among the distinct ones; those one after the other, where each begins, its size.
    which: np.ndarray
    distinct: np.ndarray
    begin: np.ndarray
    sizes: np.ndarray

    @cached_property
    def _contexts(self) -> tuple[np.ndarray, np.ndarray]:
        keys = word_keys(self.distinct, self.begin, self.sizes)
        found, number = ranked(keys)
        return keys[found], number

    @property
    def keys(self) -> np.ndarray:
        """The distinct words so far, ascending."""
        return self._contexts[0]

    @property
    def context(self) -> np.ndarray:
        """Number among ``keys`` of the word so far before each byte of ``distinct``."""
        return self._contexts[1]

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each distinct context with the byte after it stands, in the order of both, and the
        number among those of each byte of ``distinct``."""
        return ranked(self.context.astype(np.int64) << 8 | self.distinct)

    def counts(self, held: list[bool]) -> np.ndarray:
        """How often there is each distinct stretch in texts that are not held out."""
        trained = np.repeat(~np.array(held, bool), np.diff(self.upto))
        return np.bincount(self.which[trained], minlength=len(self.begin))


def spelled(texts: list[bytes]) -> Spelled:
    data = np.frombuffer(bytes([END]).join([*texts, b""]), np.uint8)
    closes = np.flatnonzero(_CLOSES[data])
    begin = np.concatenate([[0], closes[:-1] + 1])
    bounds = np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts], dtype=np.int64)])
    found, which = ranked(hashed(data, begin, closes + 1))
    sizes = closes[found] + 1 - begin[found]
    return Spelled(data, bounds, np.searchsorted(closes, bounds), which, data[_ranges(begin[found], sizes)], np.cumsum(sizes) - sizes, sizes)


# --- predictors -----------------------------------------------------------------------------


@dataclass
class Model:
    """Stretched prediction of each table row and tree node, and each byte's path in the tree."""

    stretch: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    lengths: np.ndarray

    def paths(self, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many decisions each of a sequence of bytes takes, and all their nodes and bits."""
        lengths = self.lengths[byte]
        # Along each byte's row of the table of paths.
        place = _ranges(byte.astype(np.int64) * self.nodes.shape[1], lengths)
        return lengths, self.nodes.reshape(-1).take(place), self.bits.reshape(-1).take(place)


def code_tree(counts: np.ndarray) -> tuple[list[tuple[int, int]], list[list[tuple[int, int]]]]:
    """Children of each inner node (leaves are -1 - byte), and each byte's (node, bit) path."""
    heap = [(int(c) + 1, byte, -1 - byte) for byte, c in enumerate(counts)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children.append((a[2], b[2]))
        heapq.heappush(heap, (a[0] + b[0], 256 + len(children), len(children) - 1))
    paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]

    def walk(node: int, path: list[tuple[int, int]]) -> None:
        for bit, child in enumerate(children[node]):
            here = [*path, (node, bit)]
            if child < 0:
                paths[-1 - child] = here
            else:
                walk(child, here)

    walk(len(children) - 1, [])
    return children, paths


def build_model(counts: np.ndarray) -> Model:
    """From how often each byte followed each context; ``counts`` has a row per table row."""
    # Every byte is in each of the tables once.
    children, paths = code_tree(counts[: SLOTS[0]].sum(0, dtype=float))
    stretch = np.zeros((len(counts), 256), np.int8)
    below: dict[int, np.ndarray] = {-1 - byte: counts[:, byte] for byte in range(256)}
    for node, (left, right) in enumerate(children):
        n0, n1 = below.pop(left), below.pop(right)
        below[node] = n0 + n1
        odds = np.log((n1 + PRIOR) / (n0 + PRIOR))
        stretch[:, node] = np.rint(np.clip(odds * STEP, -127, 127)).astype(np.int8)
    longest = max(map(len, paths))
    nodes, bits = np.zeros((256, longest), np.uint8), np.zeros((256, longest), np.int8)
    for byte, path in enumerate(paths):
        nodes[byte, : len(path)], bits[byte, : len(path)] = zip(*path)
    return Model(stretch.reshape(-1), nodes, bits, np.array([len(p) for p in paths], np.int32))


@dataclass
class Known:
    """For ascending context keys, where each one's following bytes begin and end in ``follow``."""

    keys: np.ndarray
    bounds: np.ndarray
    follow: np.ndarray


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All whole numbers from each beginning on, as many as its size."""
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def predicted(words: Spelled, known: Known | None, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretched predictions along the path of each distinct byte after each distinct context, where
    those of each byte of the distinct stretches begin, and how often its context was seen as one of
    the levels."""
    found, number = words.pairs
    of, byte = words.context[found], words.distinct[found]
    ends = np.cumsum(model.lengths[byte], dtype=np.int64)
    # Half as wide where that is enough: these are looked up for every byte of the texts.
    begin = (ends - model.lengths[byte]).astype(np.int32 if ends[-1] < 1 << 31 else np.int64)[number]
    level = np.zeros(len(words.keys), np.int8)
    table = np.zeros(ends[-1], np.int8)
    if known is None:
        return table, begin, level[words.context]
    at = np.searchsorted(known.keys, words.keys)
    if not (at < len(known.keys)).all() or (known.keys[at] != words.keys).any():
        raise ValueError("a context is missing: the input changed meanwhile")
    sizes = known.bounds[at + 1] - known.bounds[at]
    all_own = len(at) == len(known.keys)
    summed = np.concatenate([[0], np.cumsum(known.follow["n"])])
    level[:] = np.searchsorted(LEVELS, summed[known.bounds[at + 1]] - summed[known.bounds[at]], side="right")
    # Counts of some contexts at each node of the tree: all, and those that went on to the right.
    every, right = np.zeros(CONTEXTS_HELD * 256), np.zeros(CONTEXTS_HELD * 256)
    cuts = np.searchsorted(of, np.arange(0, len(at) + CONTEXTS_HELD, CONTEXTS_HELD, dtype=of.dtype)).tolist()
    for a, cut, until in zip(range(0, len(at), CONTEXTS_HELD), cuts, cuts[1:]):
        here = slice(a, a + CONTEXTS_HELD)
        # A block that asks for all that it knows has them side by side.
        side = slice(known.bounds[a], known.bounds[min(a + CONTEXTS_HELD, len(at))])
        follow = known.follow[side if all_own else _ranges(known.bounds[at[here]], sizes[here])]
        lengths, node, bit = model.paths(follow["byte"])
        cell = np.repeat(np.repeat(np.arange(len(sizes[here])) * 256, sizes[here]), lengths) + node
        n = np.repeat(follow["n"].astype(float), lengths)
        np.add.at(every, cell, n)
        np.add.at(right, cell, n * bit)
        some = slice(cut, until)
        lengths, node, _ = model.paths(byte[some])
        asked = np.repeat((of[some] - a) * np.int64(256), lengths) + node
        n1 = right[asked]
        odds = np.log((n1 + PRIOR) / (every[asked] - n1 + PRIOR))
        table[ends[until - 1] - len(asked) : ends[until - 1]] = np.rint(np.clip(odds * STEP, -127, 127))
        every[cell] = right[cell] = 0
    return table, begin, level[words.context]


# --- mixing ---------------------------------------------------------------------------------


def _mix(cells: np.ndarray, levels: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the logarithms of the probabilities of each span's decisions.

    ``cells`` (tile, input, step) hold ``AT_ONCE`` decisions each and their bits as the last input,
    ``levels`` (tile, update) go with them. A span's tiles stand side by side, from ``first`` on; what
    is beyond its ``sizes`` decisions in the last does not count. Spans are in descending order of size.
    """
    spans, several = len(sizes), AT_ONCE // TOGETHER
    tiles, shorter = -(-sizes // AT_ONCE), -sizes
    # The weights of an input: one for each level and span. They are for inputs in whole steps, and
    # negated, which changes no digit of them.
    start = np.asarray(START_WEIGHTS, np.float32).T * np.float32(-1 / STEP)
    weights = list(np.repeat(start, spans, axis=1))
    centres = (np.arange(REFINE_BINS) - REFINE_BINS / 2 + 0.5) / 2
    refined = np.repeat((1 / (1 + np.exp(-centres))).astype(np.float32), spans)
    rate = np.float32(-RATE) * np.float32(1 / STEP**2)
    rate, refine_rate, half, one, least = (np.array(v, np.float32) for v in (rate, REFINE_RATE, 0.5, 1, 1e-5))
    middle, double = np.array(REFINE_BINS / 2, np.float32), np.array(-2, np.float32)
    total, n = np.zeros(spans), -1
    floats = np.empty((4 + several * (INPUTS + 2) + INPUTS) * TOGETHER * spans, np.float32)
    places, wholes = np.empty(TOGETHER * spans, np.intp), np.empty(TOGETHER * spans, np.int32)
    tile, sums = np.empty((INPUTS + 1) * AT_ONCE * spans, np.int8), np.empty(AT_ONCE * spans)
    for t in range(0, int(sizes[0]), AT_ONCE):
        # Spans that have ended are dropped some at a time; what is mixed for them does not count.
        active = min(spans, -(-int(np.searchsorted(shorter, -t)) // 32) * 32)
        if active != n:
            n = active
            stacked = floats[: len(floats) // spans * n].reshape(-1, TOGETHER, n)
            (z, p, q, left), product = stacked[:4], stacked[4 : 4 + INPUTS]
            held = stacked[4 + INPUTS :].reshape(several, INPUTS + 2, TOGETHER, n)
            halves, quarters = np.empty((INPUTS, TOGETHER // 2, n), np.float32), np.empty((INPUTS, 2, n), np.float32)
            at, bins = places[: TOGETHER * n].reshape(TOGETHER, n), wholes[: TOGETHER * n].reshape(TOGETHER, n)
            lowest, highest = np.zeros(n, np.int32), np.full(n, REFINE_BINS - 1, np.int32)
            own, slope, span = np.empty((INPUTS, n), np.float32), np.empty((INPUTS, n), np.float32), np.arange(n, dtype=np.int32)
            some, summed = tile[: (INPUTS + 1) * AT_ONCE * n].reshape(n, INPUTS + 1, AT_ONCE), sums[: AT_ONCE * n].reshape(AT_ONCE, n)
            spread = some.reshape(n, INPUTS + 1, several, TOGETHER).transpose(2, 1, 3, 0)
        # Spans that are over stay in their last tile.
        place = first[:n] + np.minimum(tiles[:n] - 1, t // AT_ONCE)
        cells.take(place, axis=0, out=some, mode="clip")
        held[:, : INPUTS + 1] = spread
        np.subtract(one, held[:, INPUTS], out=held[:, INPUTS + 1])
        gates = levels.take(place, axis=0, mode="clip").T.astype(np.intp)
        gates *= spans
        gates += span
        for k in range(several):
            x, bit, unset, gate = held[k, :INPUTS], held[k, INPUTS], held[k, INPUTS + 1], gates[k]
            for weight, here in zip(weights, own):
                weight.take(gate, out=here, mode="clip")
            np.einsum("ckn,cn->kn", x, own, out=z)
            np.exp(z, out=p)
            np.add(p, one, out=p)
            np.reciprocal(p, out=p)
            np.subtract(bit, p, out=left)
            # Summed in one order, whatever else is mixed side by side.
            np.multiply(x, left, out=product)
            np.add(product[:, :4], product[:, 4:], out=halves)
            np.add(halves[:, ::2], halves[:, 1::2], out=quarters)
            np.add(quarters[:, 0], quarters[:, 1], out=slope)
            slope *= rate
            own += slope
            for weight, here in zip(weights, own):
                weight[gate] = here
            np.multiply(z, double, out=z)
            np.add(z, middle, out=z)
            np.copyto(bins, z, casting="unsafe")
            np.maximum(bins, lowest, out=bins)
            np.minimum(bins, highest, out=bins)
            np.multiply(bins, np.int32(spans), out=bins)
            np.add(bins, span, out=bins)
            np.copyto(at, bins)
            refined.take(at, out=q, mode="clip")
            np.subtract(bit, q, out=left)
            np.multiply(left, refine_rate, out=left)
            np.add(left, q, out=left)
            refined[at.reshape(-1)] = left.reshape(-1)
            np.add(p, q, out=p)
            np.multiply(p, half, out=p)
            # Of a decision for 0 that is the probability less one.
            np.subtract(p, unset, out=unset)
            np.abs(unset, out=unset)
            np.maximum(unset, least, out=unset)
            np.log(unset, out=summed[k * TOGETHER : (k + 1) * TOGETHER], dtype=np.float32)
        ended = int(np.searchsorted(shorter[:n], -(t + AT_ONCE), side="right"))
        if ended < n:
            summed[:, ended:][np.arange(t, t + AT_ONCE)[:, None] >= sizes[ended:n]] = 0
        total[:n] += summed.sum(0)
    return total


def score_texts(texts: list[bytes], model: Model, known: Known | None = None, words: Spelled | None = None) -> np.ndarray:
    """Log10 probability of each text, end mark included; without ``known`` by the last bytes alone."""
    words = spelled(texts) if words is None else words
    table, begin, level = predicted(words, known, model)
    # Arrays of NumPy's own lie in large pages, where look-ups far apart cost half; unpickled ones do not.
    stretch, total = model.stretch.copy(), np.zeros(len(texts))
    for some in _in_parts(texts, SCORED_BYTES):
        data = words.data[words.bounds[some.start] : words.bounds[some.stop]]
        predictions, levels, at = np.empty(len(data), begin.dtype), np.empty(len(data), np.int8), 0
        for a in range(words.upto[some.start], words.upto[some.stop], STRETCHES_HELD):
            which = words.which[a : min(a + STRETCHES_HELD, words.upto[some.stop])]
            here = _ranges(words.begin[which], words.sizes[which])
            into = slice(at, at + len(here))
            predictions[into], levels[into], at = begin[here], level[here], into.stop
        bounds = words.bounds[some.start : some.stop + 1] - words.bounds[some.start]
        total[some] = _score_part(data, bounds, model, stretch, table, predictions, levels)
    return total / np.log(10)


def _score_part(
    data: np.ndarray, bounds: np.ndarray, model: Model, stretch: np.ndarray, table: np.ndarray, predictions: np.ndarray, level: np.ndarray
) -> np.ndarray:
    """Natural logarithms of the probabilities of texts; ``predictions`` says where in ``table`` those
    of the word so far begin for each byte."""
    # Where each span begins and ends, and whose it is.
    spans = -(-np.diff(bounds) // SPAN)
    owner = np.repeat(np.arange(len(spans)), spans)
    begin = bounds[:-1][owner] + _ranges(np.zeros(len(spans), np.int64), spans) * SPAN
    end = np.minimum(begin + SPAN, bounds[1:][owner])
    lengths = model.lengths.astype(np.int16)[data]
    steps = np.add.reduceat(lengths, begin, dtype=np.int64)
    tiles = -(-steps // AT_ONCE)
    first = np.cumsum(tiles) - tiles
    # The last byte of a span also takes the places that do not count.
    lengths[end - 1] += (tiles * AT_ONCE - steps).astype(np.int16)
    rows, width = table_rows(data), np.int64(model.nodes.shape[1])
    both, low, nodes, bits = (1 << 40) + 1, (1 << 32) - 1, model.nodes.reshape(-1).astype(np.int64), model.bits.reshape(-1)
    cells, levels = np.empty((int(tiles.sum()), INPUTS + 1, AT_ONCE), np.int8), np.empty((int(tiles.sum()), AT_ONCE // TOGETHER), np.int8)
    edges = np.unique(np.searchsorted(begin, np.arange(0, len(data) + SPELLED_BYTES, SPELLED_BYTES)))
    for a, b in zip(edges, edges[1:]):
        here, into = slice(begin[a], end[b - 1]), slice(first[a], first[b - 1] + tiles[b - 1])
        # Two places of each byte in one number: in the tables of last bytes, and in the table of paths
        # and among ``table``. Those of the latter two move on with every decision.
        many = lengths[here].astype(np.int64)
        near = rows[0, here].astype(np.int64) << 8 | rows[1, here].astype(np.int64) << 40
        far = (data[here] * width << 40 | predictions[here]) - (np.cumsum(many) - many) * both
        byte = np.repeat(np.arange(len(many)), many)
        table_place = far.take(byte, mode="clip")
        table_place += np.arange(len(byte)) * both
        path = table_place >> 40
        table_place &= (1 << 40) - 1
        node = nodes.take(path, mode="clip")
        place = near.take(byte, mode="clip")
        other = place >> 32
        other += node
        place &= low
        place += node
        into_cells = cells[into]
        for c, (values, at) in enumerate(((stretch, place), (stretch, other), (table, table_place), (bits, path))):
            into_cells[:, c] = values.take(at, mode="clip").reshape(-1, AT_ONCE)
        levels[into] = level[here].take(byte[::TOGETHER]).reshape(-1, AT_ONCE // TOGETHER)
    order, total = np.argsort(-steps, kind="stable"), np.zeros(len(spans))
    for at in range(0, len(order), LANES):
        group = order[at : at + LANES]
        np.add.at(total, owner[group], _mix(cells, levels, steps[group], first[group]))
    return total


# --- on Spark -------------------------------------------------------------------------------


def to_blocks(batches) -> Iterator[tuple]:
    """Rows of a task as blocks of bounded text; a text that is longer makes a longer block."""
    block, ids, held, parts, size = TaskContext.get().partitionId() << 24, [], [], [], 0
    for batch in batches:
        columns = batch.column(0), batch.column(1).cast(pa.binary()), batch.column(2)
        for doc, text, out in zip(*(column.to_pylist() for column in columns)):
            ids.append(doc)
            held.append(out)
            parts.append(text)
            size += len(parts[-1]) + 1
            if size >= BLOCK_BYTES:
                yield block, ids, held, _packed(bytes([END]).join([*parts, b""]))
                block, ids, held, parts, size = block + 1, [], [], [], 0
    if ids:
        yield block, ids, held, _packed(bytes([END]).join([*parts, b""]))


_BLOCK = "block bigint, ids array<bigint>, held array<boolean>, data binary"
_ARROW_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("data", pa.binary())])


def _packed(data: bytes) -> bytes:
    """``data`` compressed by zstd after its length: what is stored and shuffled is packed."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(value: bytes) -> bytes:
    return pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)


def _texts(data: bytes) -> list[bytes]:
    return _unpacked(data).split(bytes([END]))[:-1]


def _in_parts(texts: list[bytes], most: int = HELD_BYTES) -> Iterator[slice]:
    """Runs of texts that are looked at together."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= most or i + 1 == len(texts):
            yield slice(first, i + 1)
            first, size = i + 1, 0


def count_tables(blocks: DataFrame) -> np.ndarray:
    """How often each byte followed each table row, over all training texts."""
    cells = (BEGIN[-1] + SLOTS[-1]) * 256

    def count(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for data, held in zip(batch.column("data"), batch.column("held").to_pylist()):
                texts = [text for text, out in zip(_texts(data.as_py()), held) if not out]
                for part in _in_parts(texts):
                    own = np.frombuffer(bytes([END]).join([*texts[part], b""]), np.uint8)
                    for rows in table_rows(own):
                        np.add.at(total, rows * np.intp(256) + own, 1)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["cell", "n"])

    spark, at = blocks.sparkSession, shared_dir(blocks.sparkSession, "lm-counts")
    counted = blocks.select("held", "data").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    # A stored row is a whole block of text, so one at a time: otherwise a task's whole split comes
    # at once. Stored first, so that the cells come to the driver in batches of the usual size.
    with rows_per_batch(spark, 1):
        counted.write.parquet(at)
    found = spark.read.schema("cell bigint, n bigint").parquet(at).toArrow()  # a row per cell of the tables at most
    counts = np.zeros(cells, np.float32)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    return counts.reshape(-1, 256)


def _entries(pair: np.ndarray, weights: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of each owner and all of them, from weighted ``owner * 256 + byte``."""
    found, number = ranked(pair)
    distinct = pair[found]
    follow = np.empty(len(found), _NEXT)
    follow["byte"], follow["n"] = distinct & 255, np.rint(np.bincount(number, weights=weights, minlength=len(found)))
    return np.bincount(distinct >> 8, minlength=owners), follow


def own_contexts(texts: list[bytes], held: list[bool], words: Spelled | None = None) -> Known:
    """The contexts of a block's texts, with the bytes that followed them in its training texts."""
    words = spelled(texts) if words is None else words
    found, number = words.pairs
    n = np.bincount(number, weights=np.repeat(words.counts(held), words.sizes), minlength=len(found))
    trained = np.flatnonzero(n)
    follow = np.empty(len(trained), _NEXT)
    follow["byte"], follow["n"] = words.distinct[found[trained]], np.rint(n[trained])
    sizes = np.bincount(words.context[found[trained]], minlength=len(words.keys))
    return Known(words.keys, np.concatenate([[0], np.cumsum(sizes)]), follow)


# What blocks ask and are answered travels in rows of one part of all hashes each: what is asked is
# in the order of its hash within a block, and an answer is in the order in which it was asked.

_ASKED = "part int, block bigint, keys binary, sizes binary, follow binary, counts binary"
_ARROW_ASKED = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("sizes", pa.binary()), ("follow", pa.binary()), ("counts", pa.binary())
])
_ANSWER = "block bigint, kind int, part int, sizes binary, follow binary, counts binary"
_ARROW_ANSWER = pa.schema([
    ("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("sizes", pa.binary()), ("follow", pa.binary()), ("counts", pa.binary())
])
#: Kinds of answers: on contexts, on words, and the totals of a part's words, which are for no block.
CONTEXTS, WORDS, TOTALS = 0, 1, 2


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of ascending 64-bit keys begins, and where the last ends."""
    edges = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def asked_contexts(block: int, own: Known, parts: int) -> Iterator[tuple]:
    """A block's own contexts with what followed them, by parts."""
    cuts, sizes = _cuts(own.keys, parts), np.diff(own.bounds)
    for part in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[part], cuts[part + 1]
        follow = own.follow[own.bounds[a] : own.bounds[b]]
        keys = np.diff(own.keys[a:b], prepend=np.uint64(0)).astype("<u8")  # ascending: small steps pack well
        yield (int(part), block, *map(_packed, (keys.tobytes(), sizes[a:b].astype("<u2").tobytes(),
               follow["byte"].tobytes(), follow["n"].astype("<i8").tobytes())))


def _column(table: pa.Table, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a packed binary column, and how many each row has."""
    rows = [np.frombuffer(_unpacked(value), kind) for value in table[name].to_pylist()]
    return np.concatenate([np.zeros(0, kind), *rows]), np.array([len(row) for row in rows])


def answered_contexts(asked: pa.Table) -> pa.Table:
    """For each context that several blocks ask for, one more than the number of bytes that followed
    it in any, and those with their sums; 0 for a context that its own block knows all of."""
    steps, rows = _column(asked, "keys", "<u8")
    keys = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(s, dtype=np.uint64) for s in np.split(steps, np.cumsum(rows)[:-1]))])
    sizes, follow, n = (_column(asked, name, kind)[0] for name, kind in (("sizes", "<u2"), ("follow", "u1"), ("counts", "<i8")))
    number = ranked(keys)[1]
    shared = np.bincount(number) > 1
    summed = np.repeat(shared[number], sizes)
    pair = np.repeat(number.astype(np.int64) << 8, sizes)[summed] | follow[summed]
    all_sizes, entries = _entries(pair, n[summed].astype(float), len(shared))
    begin = np.cumsum(all_sizes) - all_sizes
    out, ends = [], np.cumsum(rows)
    for block, part, size, end in zip(asked["block"].to_pylist(), asked["part"].to_pylist(), rows, ends):
        own = number[end - size : end]
        some = own[shared[own]]
        taken = entries[_ranges(begin[some], all_sizes[some])]
        told = np.where(shared[own], all_sizes[own] + 1, 0).astype("<u2")
        out.append((block, CONTEXTS, part, *map(_packed, (told.tobytes(), taken["byte"].tobytes(), taken["n"].astype("<i8").tobytes()))))
    return _answers(out)


def _answers(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(_ARROW_ANSWER)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ARROW_ANSWER)], schema=_ARROW_ANSWER)


def overlaid(own: Known, answers: pa.Table) -> Known:
    """A block's own contexts, with the sums of all blocks for those that others have too."""
    order = np.argsort(answers["part"].to_numpy())
    answers = answers.take(pa.array(order))
    told, follow, n = (_column(answers, name, kind)[0] for name, kind in (("sizes", "<u2"), ("follow", "u1"), ("counts", "<i8")))
    if len(told) != len(own.keys):
        raise ValueError("contexts are missing: the stored blocks have changed meanwhile")
    shared, own_sizes = told > 0, np.diff(own.bounds)
    sizes = np.where(shared, told.astype(np.int64) - 1, own_sizes)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    entries = np.empty(bounds[-1], _NEXT)
    at = _ranges(bounds[:-1][shared], sizes[shared])
    entries["byte"][at], entries["n"][at] = follow, n
    alone = ~shared
    entries[_ranges(bounds[:-1][alone], sizes[alone])] = own.follow[_ranges(own.bounds[:-1][alone], own_sizes[alone])]
    return Known(own.keys, bounds, entries)


@dataclass
class Words:
    """The words of a block in the order of their hashes, a space before each, where each begins and the
    last ends in ``text``, and how often it is in the block's training texts."""

    text: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    n: np.ndarray
    #: Number of each distinct stretch's word, and then of the end mark, which is the empty word.
    which: np.ndarray


def own_words(words: Spelled, held: list[bool]) -> Words:
    # White space that follows other white space ends no word, so the empty word is the end mark's alone.
    lowered = np.frombuffer(b" " + words.distinct.tobytes().lower(), np.uint8).copy()
    lowered[words.begin + words.sizes] = 32
    begin, sizes = np.append(words.begin, len(words.distinct)), np.append(words.sizes, 1)
    hashes = hashed(lowered, begin + 1, begin + sizes)
    found, which = ranked(hashes)
    like = found[which]
    if (sizes[like] != sizes).any() or (lowered[_ranges(begin[like], sizes)] != lowered).any():
        # Equal hashes of words that differ: in the order of the words themselves.
        spelling = lowered.tobytes().split(b" ")[1:]
        number = {word: i for i, (_, word) in enumerate(sorted({*zip(hashes.tolist(), spelling)}))}
        which = np.array([number[word] for word in spelling], np.int64)
        found = np.unique(which, return_index=True)[1]
    n = np.bincount(which[:-1], weights=words.counts(held), minlength=len(found)).astype(np.int64)
    n[which[-1]] = len(held) - sum(held)
    text, bounds = lowered[_ranges(begin[found], sizes[found])], np.concatenate([[0], np.cumsum(sizes[found])])
    return Words(text, bounds, hashes[found], n, which)


def asked_words(block: int, texts: list[bytes], held: list[bool], parts: int) -> Iterator[tuple]:
    own = own_words(spelled(texts), held)
    cuts = _cuts(own.hashes, parts)
    for part in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[part], cuts[part + 1]
        yield int(part), block, _packed(own.text[own.bounds[a] : own.bounds[b]].tobytes()), None, None, _packed(own.n[a:b].astype("<i8").tobytes())


def answered_words(asked: pa.Table) -> pa.Table:
    """What each word was seen in all blocks, and the sums over this part's words."""
    rows = [_unpacked(value).split(b" ")[1:] for value in asked["keys"].to_pylist()]
    number = {word: i for i, word in enumerate(dict.fromkeys(chain.from_iterable(rows)))}
    own = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in rows]
    total = np.zeros(len(number), np.int64)
    for which, counts in zip(own, asked["counts"].to_pylist()):
        total[which] += np.frombuffer(_unpacked(counts), "<i8")  # a block's words are distinct
    part = asked["part"][0].as_py()
    out = [(block, WORDS, part, None, None, _packed(total[which].astype("<i8").tobytes())) for block, which in zip(asked["block"].to_pylist(), own)]
    sums = np.array([total.sum(), (total > 0).sum()], "<i8")
    return _answers([*out, (None, TOTALS, part, None, None, _packed(sums.tobytes()))])


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased words, then the end, which is no word."""
    return [*text.lower().split(), b""]


_SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double,"
    " n_bytes bigint, bits_per_byte double"
)
_ARROW_SCORED = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()),
    ("bits_per_byte", pa.float64()),
])


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte`` of every row.

    Both models learn from all rows that are not ``held_out``. ``score`` is the mixing model's
    log10 probability of the whole text, ``base_score`` that of its words by add-one smoothed
    counts. ``n_bytes`` counts the text's bytes and its end mark, ``bits_per_byte`` is what the
    mixing model needs for each. A null text counts as empty, which has an end and nothing else.
    Repeated rows count each, in training and in the result. Without training rows every decision is
    even at first. Other columns are not read; an empty table gives an empty result.
    """
    spark, root = docs.sparkSession, shared_dir(docs.sparkSession, "lm")
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    with rows_per_batch(spark):
        blocks = texts.mapInArrow(lambda batches: batched(to_blocks(batches), _ARROW_BLOCK, most=1), _BLOCK)
        blocks.write.option("compression", "zstd").parquet(f"{root}/blocks")
    blocks = spark.read.schema(_BLOCK).parquet(f"{root}/blocks")
    model = build_model(count_tables(blocks))
    shared = spark.sparkContext.broadcast(model)  # a number per cell of the tables

    parts = max(1, blocks.count())

    def ask(batches, each, schema=_ARROW_ASKED):
        def rows():
            for batch in batches:
                for block, held, data in zip(batch.column("block").to_pylist(), batch.column("held").to_pylist(), batch.column("data")):
                    yield from each(block, _texts(data.as_py()), held)

        yield from batched(rows(), schema, size=lambda r: len(r[2]) + len(r[5]))

    def contexts_asked(batches):
        yield from ask(batches, lambda block, texts, held: asked_contexts(block, own_contexts(texts, held), parts))

    def words_asked(batches):
        yield from ask(batches, lambda block, texts, held: asked_words(block, texts, held, parts))

    read = blocks.select("block", "held", "data")
    words = read.mapInArrow(words_asked, _ASKED).groupBy("part").applyInArrow(answered_words, _ANSWER)
    with rows_per_batch(spark, 1):
        words.write.option("compression", "zstd").parquet(f"{root}/words")
    words = spark.read.schema(_ANSWER).parquet(f"{root}/words")
    sums = [np.frombuffer(_unpacked(r.counts), "<i8") for r in words.where(F.col("kind") == TOTALS).select("counts").toLocalIterator()]
    n_train, distinct = (int(n) for n in np.sum([np.zeros(2, np.int64), *sums], axis=0))

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        of_words = right.filter(pc.equal(right["kind"], WORDS))
        of_words = of_words.take(pa.array(np.argsort(of_words["part"].to_numpy())))
        seen = _column(of_words, "counts", "<i8")[0]
        of_contexts = right.filter(pc.equal(right["kind"], CONTEXTS))
        tables = []
        for ids, held, data in zip(*(left[name].to_pylist() for name in ("ids", "held", "data"))):
            found = _texts(data)
            words = spelled(found)
            which = own_words(words, held).which
            if len(seen) <= which.max():
                raise ValueError("words are missing: the stored blocks have changed meanwhile")
            # Of each distinct stretch; that of the end mark alone is counted once for each text.
            word = words.sizes > 1
            count, end = np.where(word, seen[which[:-1]], 0), int(seen[which[-1]])
            owner = np.repeat(np.arange(len(found)), np.diff(words.upto))
            n_tokens, n_known, base = (
                np.bincount(owner, weights=each[words.which], minlength=len(found)) for each in (word, count > 0, np.log10(count + 1.0))
            )
            n_tokens, n_known = (n_tokens + 1).astype(np.int64), (n_known + (end > 0)).astype(np.int64)
            base += np.log10(end + 1) - n_tokens * np.log10(n_train + distinct + 1)
            score = score_texts(found, shared.value, overlaid(own_contexts(found, held, words), of_contexts), words)
            n_bytes = np.diff(words.bounds)
            columns = (ids, held, n_tokens, n_known, np.full(len(found), n_train), base, score, n_bytes, -score * np.log2(10) / n_bytes)
            tables.append(pa.table([pa.array(column, f.type) for column, f in zip(columns, _ARROW_SCORED)], schema=_ARROW_SCORED))
        return pa.concat_tables(tables) if tables else _ARROW_SCORED.empty_table()

    answers = read.mapInArrow(contexts_asked, _ASKED).groupBy("part").applyInArrow(answered_contexts, _ANSWER)
    sent = answers.unionByName(words.where(F.col("kind") == WORDS))
    return blocks.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(judge, _SCORED)
