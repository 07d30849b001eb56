"""Operators on documents: edge cases, brute force, round trips and held-out accuracy."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from turnout.llm import dedup, jaccard, lm, mixing, packing, quality, rans, toxicity
from turnout.llm.labelled import remainder
from turnout.llm.tokens import Encoder, batched, default_tokenizer

SMALL = f"{TESTDATA}/sf0.001"
SCHEMA = "doc_id bigint, text string, source string, copy int, n bigint, label string, digest string"
#: Nulls, empty and blank texts, a very long one, ties and repeated rows; the other columns clash.
ODD = [
    (1, "one two three four five six", "a"), (2, "One two three four five six", "a"), (3, None, "a"), (4, "", None),
    (5, " \n\t", "b"), (6, "word " * 30_000, "b"), (7, "one two three four five six", "b"),
    (7, "one two three four five six", "b"), (8, "x", "c"), (None, "alone in the null row", None),
    (9, "it's <|endoftext|> H̱ello, ﬁne! 12.5 $$$ naïve ÉTÉ", "c"),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, 9, "x", "y") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture
def stored(spark, tmp_path):
    def store(rows):
        table(spark, rows).repartition(3).write.parquet(str(tmp_path / "docs"))
        return spark.read.parquet(str(tmp_path / "docs"))

    return store


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_tokenizer())


def plain(encoder, text):
    return encoder._encode(text or "").tobytes() + b"\1\0\0\0"


# --- exact dedup ----------------------------------------------------------------------------


@pytest.mark.parametrize("digest", [dedup.sha256, lambda t: F.unhex(F.lpad(F.hex(F.crc32(t) % 3), 2, "0"))])
def test_exact_dedup_equals_grouping_by_text(stored, digest):
    docs = stored(ODD)
    got = Counter((r.id, r.keep_id, r.group_size, r.kept) for r in dedup.exact_dedup(docs, digest=digest).collect())
    groups = {}
    for doc, text, _ in ODD:
        groups.setdefault(text or "", []).append(doc)
    want = Counter()
    for ids in groups.values():
        keep = max(ids, key=lambda i: -1 if i is None else i)
        for i, doc in enumerate(sorted(ids, key=lambda i: -1 if i is None else i)):
            want[(doc, keep, len(ids), i == len(ids) - 1)] += 1
    assert got == want


def test_exact_dedup_state_goes_on(spark, stored, folder):
    docs = stored([(1, "a", "s"), (2, "a", "s")])
    dedup._digested(docs, "doc_id", "text", dedup.sha256).write.parquet(folder("digests"))
    first = dedup.update_state(spark, folder("digests"), folder("state")).collect()
    dedup._digested(docs, "doc_id", "text", dedup.sha256).write.mode("append").parquet(folder("digests"))
    second = dedup.update_state(spark, folder("digests"), folder("state")).collect()
    assert [r.n for r in first] == [2] and [(r.n, r.kept.id) for r in second] == [(4, 2)]


def test_drop_exact_copies_keeps_columns(stored):
    docs = stored(ODD)
    left = dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert left.count() == len({t or "" for _, t, _ in ODD})


# --- tokens ---------------------------------------------------------------------------------


def test_encoder_equals_the_library(encoder):
    for _, text, _ in ODD:
        assert encoder(text or "") + b"\1\0\0\0" == plain(encoder, text)


def test_encoder_equals_the_library_on_random_strings(encoder):
    """Latin and other letters, the capital I with a dot among them, marks, white space and signs."""
    pick = random.Random(5)
    letters = [chr(i) for i in range(0x41, 0x250) if chr(i).isalpha()]
    others = [chr(i) for i in range(0x20, 0x250)] + list("İıſßΣςά́̇中文😀ﬁ\x1c\t\n'")
    for _ in range(20_000):
        text = "".join(pick.choice(letters if pick.random() < 0.8 else others) for _ in range(pick.randrange(1, 12)))
        text += pick.choice(["", ".", ",", "!!", "'s", "İ.", " BİLGİ."])
        assert encoder(text) + b"\1\0\0\0" == plain(encoder, text)


def test_encoder_remembers_a_bounded_number_of_bytes():
    small = Encoder(default_tokenizer(), 20_000)
    pick = random.Random(6)
    words = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyzé", k=pick.randrange(1, 9))) for _ in range(3000)]
    for at in range(0, 3000, 30):
        text = " ".join([*words[at : at + 30], "often", "Often."])
        assert small(text) + b"\1\0\0\0" == plain(small, text)
        assert small._known.bytes < 20_000 and len(small._known.old) < 200
    assert "often" in small._known


def test_packing_places_every_token_once(odd, encoder):
    packed = packing.pack(odd, size=64)
    rows = packed.collect()
    ids = Counter()
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 256
    for (doc, text, _), n in Counter(ODD).items():
        whole = plain(encoder, text)
        for start in range(0, len(whole) // 4, 64):
            ids[(doc, start // 64, whole[4 * start : 4 * start + 256])] += n
    assert ids == Counter((r.doc_id, r.piece, bytes(r.ids)) for r in rows)
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    for (s, o, n), (t, p, _) in zip(places, places[1:]):
        assert (t, p) == (s, o + n) or (t != s and p == 0)
    filled = packing.sequences(packed).collect()
    assert max(len(r.ids) for r in filled) <= 256
    assert sum(len(r.ids) for r in filled) == sum(4 * r.length for r in rows)


def test_plan_is_close_to_the_least_number_of_sequences():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6.3, 0.9, 50_000).astype(int) + 1, 1, 4096)
    counts = Counter(lengths.tolist())
    plan = packing.plan_packing(counts)
    assert plan.sequences <= 1.01 * math.ceil(lengths.sum() / 4096)
    filled = np.zeros(plan.sequences, np.int64)
    for length, n in counts.items():
        sequence, _ = plan.place(np.full(n, length), np.arange(n))
        np.add.at(filled, sequence, length)
    assert filled.max() <= 4096


def test_nnls_finds_the_minimum():
    rng = np.random.default_rng(2)
    a = rng.random((6, 10))
    x = np.maximum(rng.normal(size=10), 0)
    assert np.allclose(a @ packing.nnls(a, a @ x), a @ x, atol=1e-8)


def test_rans_round_trip_and_checksum():
    rng = np.random.default_rng(3)
    for n in (1, 31, 8192, 20_001):
        ids = (rng.zipf(1.3, n) % 5000).astype(np.int64)
        code = rans.Table(rans.scaled(np.bincount(ids, minlength=5000)))
        coded = rans.encode_ids(ids, code)
        assert (rans.decode_ids(coded, n, code.slots()) == ids).all()
    broken = coded | {"words": bytes(64) + coded["words"][64:]}
    with pytest.raises(ValueError, match="checksum"):
        rans.decode_ids(broken, n, code.slots())


def test_token_files_round_trip(spark, odd, encoder, folder):
    rans.write_ids(odd, folder("ids"))
    rows = sorted(rans.read_ids(spark, folder("ids")).collect(), key=lambda r: r.start)
    at = 0
    for r, (doc, text, _) in zip(rows, sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), strict=True):
        whole = plain(encoder, text)
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (doc, at, len(whole) // 4, whole)
        at += r.n_tokens


def test_token_sections_are_encoded_one_at_a_time(spark, odd, folder, monkeypatch):
    """A staged row holds a whole section; more of them at once grow a task's memory with its split."""
    seen, write = {}, type(odd.write).parquet

    def parquet(self, path, *args, **kwargs):
        seen[path.rsplit("/", 1)[-1]] = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(type(odd.write), "parquet", parquet)
    rans.write_ids(odd, folder("ids"))
    assert seen["sections"] == "1"



def test_text_blocks_are_read_one_at_a_time(spark, odd, monkeypatch):
    """A stored row holds a whole block of text; more of them at once grow a task's memory with its split."""
    seen, write = {}, type(odd.write).parquet

    def parquet(self, path, *args, **kwargs):
        seen[path.rsplit("/", 1)[-1]] = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(type(odd.write), "parquet", parquet)
    lm.score_documents(odd, F.lit(False)).count()
    assert seen["words"] == "1"
    assert next(v for k, v in seen.items() if k.startswith("lm-counts")) == "1"

# --- similarity -----------------------------------------------------------------------------


def grouped(rows, width, percent):
    """Set sizes and least reachable ids by comparing all pairs."""
    sets = {}
    for doc, text, _ in rows:
        words = (text or "").encode().lower().split()
        if doc is not None:
            sets[doc] = {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    label = {doc: doc for doc in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {doc: (len(s), label[doc]) for doc, s in sets.items()}


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_jaccard_equals_all_pairs(spark, width, percent):
    pick = random.Random(width)
    rows = [r for r in ODD if r[0] != 6]
    for base in range(25):
        words = [f"w{pick.randrange(400)}" for _ in range(pick.choice([3, 8, 14, 40, 200]))]
        for _ in range(6):
            near = list(words)
            for _ in range(pick.randrange(0, 1 + len(words) // 12)):
                near[pick.randrange(len(near))] = f"n{pick.randrange(10**6)}"
            rows.append((100 + len(rows), " ".join(near), "s"))
    got = jaccard.jaccard_groups(table(spark, rows), width, percent, screened=percent < 85).collect()
    assert len(got) == len(rows)
    want = grouped(rows, width, percent)
    assert len({g for _, g in want.values()}) < len(want)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]


@pytest.mark.parametrize("screened", [True, False])
def test_jaccard_over_several_blocks_equals_all_pairs(spark, monkeypatch, screened):
    """A large cluster of near copies that no block holds whole, and a passage in very many texts."""
    monkeypatch.setattr(jaccard, "BLOCK", 1500)
    monkeypatch.setattr(jaccard, "SIGNED_BLOCK", 2500)
    pick = random.Random(11)
    passage = [f"p{i}" for i in range(30)]
    base = [f"w{pick.randrange(5000)}" for _ in range(150)]
    rows = []
    for k in range(90):
        words = list(base) if k < 40 else [f"x{k}.{i}" for i in range(150)]
        for _ in range(pick.randrange(0, 5)):
            words[pick.randrange(150)] = f"n{pick.randrange(10**6)}"
        at = pick.randrange(150)
        rows.append((200 - k, " ".join([*words[:at], *passage, *words[at:]] if k % 2 else words), "s"))
    want = grouped(rows, 5, 80)
    for r in jaccard.jaccard_groups(table(spark, rows), 5, 80, screened=screened).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id]


def test_tolerant_and_exact_allocations_share_a_key():
    rng = np.random.default_rng(4)
    for percent in (80, 85):
        for band in range(4, 22):
            low = int(jaccard.band_starts()[band])
            tolerant, exact, left_out = jaccard.allocation(band, percent)
            high = int(jaccard.band_starts()[band + 1]) - 1
            assert 2 * tolerant + exact - left_out > jaccard.most_differences(high, percent)
            for _ in range(20):
                a = np.unique(rng.integers(0, 1 << 63, low, dtype=np.uint64) * np.uint64(2))
                differ = int(len(a) * (100 - percent) / (100 + percent))
                b = np.unique(np.concatenate([a[differ:], rng.integers(0, 1 << 63, differ, dtype=np.uint64)]))
                common = len(np.intersect1d(a, b))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    assert len(np.intersect1d(jaccard.keys_of(a, percent), jaccard.keys_of(b, percent)))


def test_one_of_each_group_keeps_columns(odd):
    left = jaccard.one_of_each_group(odd)
    assert left.columns == odd.columns
    # Rows 1, 2 and both rows 7 are one group; everything else has no match.
    assert left.count() == len(ODD) - 3


# --- mixing ---------------------------------------------------------------------------------


def test_mixing_reaches_the_weights(spark):
    rows = [(i, f"text {i}", "big" if i % 10 else ("small" if i % 20 else None)) for i in range(4000)]
    weights = spark.createDataFrame([("big", 1.0), ("small", 2.0), (None, 1.0)], "source string, weight double")
    out = mixing.mix(table(spark, rows), weights, total=40_000)
    counts = {r.source: r.n for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(counts["big"] - 10_000) < 500 and abs(counts["small"] - 20_000) < 700 and abs(counts[None] - 10_000) < 500
    first, again = (sorted(map(tuple, d.select("doc_id", "copy", "shuffle_key").collect())) for d in (out, mixing.mix(table(spark, rows).repartition(5), weights, total=40_000)))
    assert first == again


def test_mixing_high_rates_and_absent_sources(spark):
    rows = [(1, "only", "tiny"), (2, "other", "out")]
    weights = spark.createDataFrame([("tiny", 1.0)], "source string, weight double")
    out = mixing.mix(table(spark, rows), weights, total=1000).collect()
    assert {r.source for r in out} == {"tiny"} and 850 < len(out) < 1150
    assert sorted(r.copy for r in out) == list(range(1, len(out) + 1))


@pytest.mark.parametrize("percent", [80, 85])
def test_signatures_rule_out_no_link(percent):
    """Sets of all sizes with copies that differ in about as much as links may."""
    rng = np.random.default_rng(percent)
    sets = []
    for n in (64, 70, 100, 127, 128, 129, 250, 260, 600, 3000):
        for _ in range(4):
            base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
            sets.append(np.unique(base))
            for share in (0.98, percent / 100 + 0.01, percent / 100, percent / 100 - 0.02):
                sets.append(np.unique(base[: int(n * share)]))
                changed = base.copy()
                changed[: int(n * (1 - share) / (1 + share))] ^= np.uint64(0x123456789ABCDEF)
                sets.append(np.unique(changed))
    sizes, sides = np.array([len(s) for s in sets]), np.array([i % 2 == 0 for i in range(len(sets))])
    for two in (sides, np.ones(len(sets), bool)):
        near = jaccard.near_forest(sizes, [jaccard.signature(s) for s in sets], two, percent)
        label = list(range(len(sets)))
        for a, b in near:
            label = [label[a] if x == label[b] else x for x in label]
        exact = jaccard.linked_forest(sets, two, percent)
        assert exact and all(label[a] == label[b] for a, b in exact if min(sizes[a], sizes[b]) >= jaccard.LEAST_SIGNED)
    # Sets that have nothing to do with each other are nearly all out.
    apart = [np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)) for _ in range(200)]
    assert not jaccard.near_forest(np.full(200, 500), [jaccard.signature(s) for s in apart], np.ones(200, bool), percent)


def test_mix_is_in_the_order_of_its_key_over_all_partitions(spark, folder):
    rows = [(i, "t", f"s{i % 3}") for i in range(3000)] + [(None, None, None), (None, None, None), (7, "x" * 100_000, "s1"), (7, "", "s1")]
    mixed = mixing.mix(table(spark, rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = mixed.select("shuffle_key", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    keys = [r.shuffle_key for r in sorted(parts, key=lambda r: r.place)]
    assert len({r.part for r in parts}) > 3 and keys == sorted(keys)


# --- models ---------------------------------------------------------------------------------


def test_lm_equals_plain_counts_and_is_a_distribution(odd):
    held_out = remainder(F.col("doc_id"), 7) == 2
    rows = lm.score_documents(odd, held_out).collect()
    out = {doc: doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2 for doc, _, _ in ODD}
    counts = Counter(w for doc, text, _ in ODD if not out[doc] for w in lm.words_of((text or "").encode()))
    total, distinct = sum(counts.values()), len(counts)
    texts = {}
    for doc, text, _ in ODD:
        texts.setdefault(doc, text or "")
    for r in rows:
        words = lm.words_of(texts[r.doc_id].encode())
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[r.doc_id], len(words), total)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words))
        n = len(texts[r.doc_id].encode()) + 1
        assert r.score < 0 and r.n_bytes == n and r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / n)


def plain_score(text, trained):
    """A text's probability decision by decision, with contexts and counts kept in dictionaries."""
    spell = lambda t: t + bytes([lm.END])
    tables, words = [{} for _ in lm.ORDERS], {}
    slot = lambda before, at: int(lm.contexts(np.frombuffer(before + b"x", np.uint8))[0][at][-1])

    def each(data):
        for i in range(len(data)):
            yield [slot(data[:i], at) for at in range(len(lm.ORDERS))], re.split(rb"[\x09-\x0d ]", data[:i])[-1], data[i]

    for other in trained:
        for slots, word, byte in each(spell(other)):
            for table, row in zip(tables, slots):
                table.setdefault(row, Counter())[byte] += 1
            words.setdefault(word, Counter())[byte] += 1
    children, paths = lm.code_tree(np.array([sum(c[b] for c in tables[0].values()) for b in range(256)], float))
    leaves = lambda node: {-1 - node} if node < 0 else leaves(children[node][0]) | leaves(children[node][1])
    weights = [list(w) for w in lm.START_WEIGHTS]
    refined = [1 / (1 + math.exp(-((b - lm.REFINE_BINS / 2 + 0.5) / 2))) for b in range(lm.REFINE_BINS)]
    steps = []
    for slots, word, byte in each(spell(text)):
        seen = words.get(word, Counter())
        level = int(np.searchsorted(lm.LEVELS, sum(seen.values()), side="right"))
        for node, bit in paths[byte]:
            inputs = []
            for counts in [*(t.get(row, Counter()) for t, row in zip(tables, slots)), seen]:
                n0, n1 = (sum(counts[b] for b in leaves(child)) for child in children[node])
                odds = math.log((n1 + lm.PRIOR) / (n0 + lm.PRIOR))
                inputs.append(round(max(-127, min(127, odds * lm.STEP))) / lm.STEP)
            steps.append((inputs, bit, level))
    total = 0.0
    for t in range(0, len(steps), lm.TOGETHER):
        some, own = steps[t : t + lm.TOGETHER], weights[steps[t][2]]
        z = [sum(a * b for a, b in zip(own, inputs)) for inputs, _, _ in some]
        p = [1 / (1 + math.exp(-v)) for v in z]
        bins = [min(lm.REFINE_BINS - 1, max(0, int(v * 2 + lm.REFINE_BINS / 2))) for v in z]
        before = list(refined)
        for v, b, (_, bit, _) in zip(p, bins, some):
            final = (v + before[b]) / 2
            total += math.log10(max(1e-5, final if bit else 1 - final))
            refined[b] = before[b] + lm.REFINE_RATE * (bit - before[b])
        weights[steps[t][2]] = [w + lm.RATE * sum((bit - v) * inputs[c] for v, (inputs, bit, _) in zip(p, some)) for c, w in enumerate(own)]
    return total


def test_lm_score_equals_a_plain_decision_by_decision_one(spark):
    pick = random.Random(3)
    words = ["the", "then", "thesis", "of", "ofen", "an", "Ünï", "x"]
    texts = ["".join(pick.choice(words) + pick.choice([" ", " ", "\n", ". "]) for _ in range(pick.randrange(1, 14))) for _ in range(12)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(20, "", "s"), (21, None, "s"), (22, "unseen words only", "s")]
    held = F.col("doc_id").isin(3, 4, 22)
    trained = [(t or "").encode() for i, t, _ in rows if i not in (3, 4, 22)]
    got = {r.doc_id: r.score for r in lm.score_documents(table(spark, rows), held).collect()}
    for doc, text, _ in rows:
        assert got[doc] == pytest.approx(plain_score((text or "").encode(), trained), rel=1e-3)


def test_lm_probabilities_sum_to_one():
    """Over all ways that a text may go on by one byte, from any state of the mixer."""
    texts = [b"abracadabra", b"abba", b"cab"]
    counts = np.zeros((sum(lm.SLOTS), 256), np.float32)
    for text in texts:
        data = np.frombuffer(text + bytes([lm.END]), np.uint8)
        for rows in lm.contexts(data)[0]:
            np.add.at(counts, (rows, data), 1)
    model = lm.build_model(counts)
    known = lm.own_contexts([*texts, *(b"abr" + bytes([b]) for b in range(255))], [False] * 3 + [True] * 255)
    whole = lm.score_texts([b"ab" + bytes([b]) for b in range(255)] + [b"ab"], model, None)
    # A text with its end and one byte more, without the end of the longer one, share their beginning.
    assert 0 < (10.0**whole).sum() < 1
    assert (0.5 ** model.lengths.astype(float)).sum() == pytest.approx(1.0) and len(known.keys)


def test_lm_code_tree_spells_every_byte():
    counts = np.zeros((sum(lm.SLOTS), 256), np.float32)
    counts[: lm.SLOTS[0], 97] = 5
    model = lm.build_model(counts)
    assert (0.5 ** model.lengths.astype(float)).sum() == pytest.approx(1.0)
    assert lm.score_texts([b"aaaa"], model)[0] > lm.score_texts([b"zzzz"], model)[0]
    many = [b"ab" * 3000, b"", b"a"]
    assert lm.score_texts(many, model).tolist() == pytest.approx([lm.score_texts([t], model)[0] for t in many])


def test_lm_counts_of_contexts_grow_with_the_corpus(spark, monkeypatch):
    """Of every word so far, a block is answered with the counts of all blocks."""
    pick = random.Random(7)
    texts = ["".join(pick.choices("abcdefghijklmnop ", k=40)) for _ in range(3000)]
    rows = spark.createDataFrame([(i, t, i % 5 == 0) for i, t in enumerate(texts)], "id bigint, text string, held_out boolean")
    blocks = rows.repartition(3).mapInArrow(lambda batches: batched(lm.to_blocks(batches), lm._ARROW_BLOCK, most=1), lm._BLOCK).cache()
    stored = [(r.block, lm._texts(bytes(r.data)), r.held) for r in blocks.collect()]
    asked = [row for block, found, held in stored for row in lm.asked_contexts(block, lm.own_contexts(found, held), 4)]
    answered = []
    for part in range(4):
        rows = [row for row in asked if row[0] == part]
        answered.append(lm.answered_contexts(pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), lm._ARROW_ASKED)], schema=lm._ARROW_ASKED)))
    answers = pa.concat_tables(answered[::-1])
    want = {}
    for i, text in enumerate(texts):
        for at in range(len(text) + 1):
            word = (text + "$")[:at].split(" ")[-1]
            follow = want.setdefault(word, Counter())
            if i % 5:
                follow[text.encode()[at] if at < len(text) else lm.END] += 1
    seen = 0
    assert len(stored) == 3
    for block, found, held in stored:
        known = lm.overlaid(lm.own_contexts(found, held), answers.filter(pc.equal(answers["block"], block)))
        for text in found[:200]:
            data = np.frombuffer(text + bytes([lm.END]), np.uint8)
            for at, key in enumerate(lm.contexts(data)[1]):
                k = int(np.searchsorted(known.keys, key))
                assert known.keys[k] == key
                got = {int(b): int(n) for b, n in known.follow[known.bounds[k] : known.bounds[k + 1]]}
                assert got == dict(want[text[:at].decode().split(" ")[-1]])
                seen += 1
    assert seen > 20_000 and len(want) > 20_000
    blocks.unpersist()


def test_lm_remembers_a_passage_however_much_else_there_is(spark):
    pick = random.Random(8)
    passage = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=400))
    other = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=400)) for _ in range(2000)]
    rows = [(2, passage, "a"), (3, other[0][::-1], "a"), (4, passage, "a"), *((10 + i, t, "a") for i, t in enumerate(other))]
    scores = {r.doc_id: r.score for r in lm.score_documents(table(spark, rows), F.col("doc_id").isin(2, 3)).where("doc_id < 10").collect()}
    assert scores[2] == pytest.approx(scores[4]) and scores[2] > 0.5 * scores[3]


@pytest.mark.parametrize("fit, module, label, threshold", [
    (quality.fit, quality, "quality", 0.7), (toxicity.fit, toxicity, "toxic", 0.5),
])
def test_classifiers_on_held_out_documents(spark, fit, module, label, threshold):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")
    held_out = remainder(F.col("doc_id"), 4) == 2
    scored = module.score(docs, fit(docs, labels, ~held_out)).where(held_out).join(labels, "doc_id")
    right = [(r.score >= threshold) == (r[label] == 1) for r in scored.collect()]
    assert sum(right) / len(right) > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_without_labels_and_on_odd_rows(spark, odd, module):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = module.score(odd, module.fit(odd, none, F.lit(True))).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)


def test_quality_scorer_equals_its_features():
    model = quality.Model(np.random.default_rng(0).normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    texts = [text or "" for _, text, _ in ODD if len(text or "") < 1000]
    for text, score in zip(texts, quality.Scorer(model)(texts)):
        found = quality.features(text)
        logit = model.contribution[found].astype(float).sum() / max(1, len(found)) + model.bias
        assert score == pytest.approx(1 / (1 + math.exp(-logit)))


def test_quality_of_a_long_unspaced_text_depends_on_its_end():
    model = quality.Model(np.random.default_rng(0).normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    start = "\u4e00\u4e8c\u4e09" * 200
    texts = [start + "x" * 50 + " a", start + "x" * 50 + "yz" * 300 + " a", "a" + "bA0-" * 30, "a" + "bA0-" * 30 + "+"]
    scorer = quality.Scorer(model)
    for scores in (scorer(texts), scorer(texts[::-1])[::-1]):
        assert abs(scores[0] - scores[1]) > 1e-3
        for text, score in zip(texts, scores):
            found = quality.features(text)
            logit = model.contribution[found].astype(float).sum() / len(found) + model.bias
            assert score == pytest.approx(1 / (1 + math.exp(-logit)))
    assert not any(len(word) > quality.LONGEST for word in scorer.words)
    # All n-grams of the end are among the features, and the shape has no cut either.
    assert quality._bucket(b"zyz>") in quality.features(texts[1][:-2])
    assert quality.shape(texts[2].encode()) != quality.shape(texts[3].encode())


# --- empty tables ---------------------------------------------------------------------------


def test_empty_tables(spark, stored, folder):
    docs = stored([])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert dedup.exact_dedup(docs).count() == 0
    assert packing.pack(docs).count() == 0
    rans.write_ids(docs, folder("ids"))
    assert rans.read_ids(spark, folder("ids")).count() == 0
    assert jaccard.jaccard_groups(docs).count() == 0
    assert mixing.mix(docs).count() == 0
    assert lm.score_documents(docs, F.lit(False)).count() == 0
    assert quality.score(docs, quality.fit(docs, labels, F.lit(True))).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels, F.lit(True))).count() == 0
