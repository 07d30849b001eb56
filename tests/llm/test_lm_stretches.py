"""The language model works out what repeats once, and mixes spans side by side whatever their sizes."""

import numpy as np
import pytest

from turnout.llm import lm


def _texts(seed=5):
    pick = np.random.default_rng(seed)
    words = [pick.choice(np.frombuffer(b"abcdefghijklmnop,.", np.uint8), size).tobytes() for size in pick.integers(1, 9, 300)]
    return [b"".join(words[i] + (b" ", b"\n", b"  ")[i % 3] for i in pick.integers(0, 300, size)) for size in (0, 1, 5, 40, 700, 2500, 3)]


def test_contexts_are_worked_out_once_for_each_distinct_stretch():
    texts = [*_texts(), b"", b" ", "Ünï ünï".encode(), b"x" * 5000] * 3
    words = lm.spelled(texts)
    assert len(words.distinct) * 10 < len(words.data) and len(words.begin) * 20 < len(words.which)
    here = lm._ranges(words.begin[words.which], words.sizes[words.which])
    assert np.array_equal(words.distinct[here], words.data)
    assert np.array_equal(words.keys[words.context[here]], lm.contexts(words.data)[1])
    assert (words.keys[1:] > words.keys[:-1]).all()
    assert [words.data[a:b - 1].tobytes() for a, b in zip(words.bounds, words.bounds[1:])] == texts


def test_keys_are_told_apart_in_their_last_bits_too():
    pick = np.random.default_rng(2)
    for keys in (
        (np.uint64(1) << np.uint64(63)) + pick.integers(0, 50, 3000).astype(np.uint64), pick.integers(0, 1 << 63, 40, dtype=np.uint64)[pick.integers(0, 40, 3000)],
        pick.integers(0, 70, 3000), np.zeros(0, np.uint64), np.array([7], np.uint64),
    ):
        found, number = lm.ranked(keys)
        distinct, inverse = np.unique(keys, return_inverse=True)
        assert np.array_equal(keys[found], distinct) and np.array_equal(number, inverse)


@pytest.mark.parametrize("alike", [False, True])
def test_words_of_a_block_are_counted_by_stretch(monkeypatch, alike):
    """Words are told apart though their hashes are equal, and asked for by their hashes."""
    texts, held = [b"The  the\tTHE\nof", b"", b"of\x0bThe ", b" unseen of"], [False, False, False, True]
    words = lm.spelled(texts)
    monkeypatch.setattr(lm, "spelled", lambda texts: words)
    if alike:
        monkeypatch.setattr(lm, "hashed", lambda data, begin, end, plain=lm.hashed: plain(data, begin, end) % np.uint64(2) << np.uint64(62))
    own, asked = lm.own_words(words, held), list(lm.asked_words(5, texts, held, 4))
    spelling = own.text.tobytes().split(b" ")[1:]
    assert dict(zip(spelling, own.n.tolist())) == {b"the": 4, b"of": 2, b"": 3, b"unseen": 0} and len(spelling) == 4
    assert (own.hashes[1:] >= own.hashes[:-1]).all() and np.array_equal(np.diff(own.bounds), [len(word) + 1 for word in spelling])
    stretches = [words.distinct[a : a + size - 1].tobytes().lower() for a, size in zip(words.begin, words.sizes)]
    assert [spelling[i] for i in own.which] == [*stretches, b""]
    assert b"".join(lm._unpacked(row[2]) for row in asked) == own.text.tobytes()


def test_spans_of_all_sizes_are_mixed_side_by_side(monkeypatch):
    texts, held = _texts(), [False] * 6 + [True]
    counts = np.zeros((sum(lm.SLOTS), 256), np.float32)
    for text in texts[:6]:
        data = np.frombuffer(text + bytes([lm.END]), np.uint8)
        for rows in lm.table_rows(data):
            np.add.at(counts, (rows, data), 1)
    model, known = lm.build_model(counts), lm.own_contexts(texts, held)
    whole = lm.score_texts(texts, model, known)
    assert whole == pytest.approx(np.concatenate([lm.score_texts([text], model, known) for text in texts]), rel=1e-9)
    monkeypatch.setattr(lm, "LANES", 3)
    monkeypatch.setattr(lm, "SCORED_BYTES", 2000)
    monkeypatch.setattr(lm, "CONTEXTS_HELD", 7)
    assert lm.score_texts(texts, model, known) == pytest.approx(whole, rel=1e-9)
