"""What the language model stores and shuffles between its steps is packed."""

import numpy as np

from turnout.llm import lm


def test_asked_contexts_are_packed_and_round_trip():
    letters = np.random.default_rng(3).choice(np.frombuffer(b"abcdefgh ", np.uint8), (400, 300))
    texts = [row.tobytes() for row in letters]
    own = lm.own_contexts(texts, [False] * len(texts))
    rows = list(lm.asked_contexts(7, own, 3))
    plain = own.keys.nbytes + len(own.keys) * 2 + own.follow.size * 9
    assert sum(len(value) for row in rows for value in row[2:]) * 2 < plain
    keys = np.concatenate([np.cumsum(np.frombuffer(lm._unpacked(row[2]), "<u8"), dtype=np.uint64) for row in rows])
    assert np.array_equal(keys, own.keys)


def test_stored_blocks_are_packed():
    data = bytes([lm.END]).join([b"a text that repeats itself " * 50] * 20 + [b""])
    assert len(lm._packed(data)) * 10 < len(data)
    assert lm._texts(lm._packed(data)) == data.split(bytes([lm.END]))[:-1]
