"""URL filter and vector search; registered queries against SQL; the pipeline against plain Python."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from turnout.llm import queries, search, urls

SF_DIR = f"{TESTDATA}/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = queries.queries()[name](spark, SF_DIR)
    columns = ", ".join(f'"{c}"' for c in result.columns)
    theirs = duck.sql(f"SELECT {columns} FROM ({queries.oracle_sql()[name]})")
    assert Counter(map(tuple, result.collect())) == Counter(theirs.fetchall())


# --- URLs -----------------------------------------------------------------------------------

PAGES = [
    (1, "https://WWW.Example.org/es/x?q#f"), (2, "http://example.org/en/12"), (3, "http://a.org"), (4, "http://a.org/"),
    (5, None), (6, ""), (7, "no host"), (8, "x://b.com/fr/?a=/de/"), (9, "http://b.com/de/#"), (9, "http://b.com/de/#"),
    (10, "http://notexample.org/es/"), (11, "http://com/fr/"), (12, "://?q://x.org/"), (13, "http://é.net/ü\nx"), (None, "http://q.net/"),
    (14, "http://z.net/" + "a" * 50_000),
]


def _plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([len(rest), *(rest.find(c) for c in "/?#" if c in rest)])
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([len(tail), *(tail.find(c) for c in "?#" if c in tail)])]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def _plain_grams(url):
    codes = [urls.START, urls.START] + [urls.ALPHABET.find(c) + 1 for c in "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")]
    return [(codes[i] * urls.SYMBOLS + codes[i + 1]) * urls.SYMBOLS + codes[i + 2] for i in range(len(codes) - 2)]


def test_url_filter_equals_plain_python(spark):
    pages = spark.createDataFrame([(*p, "x", 0) for p in PAGES], "page_id bigint, url string, rule string, gram int")
    got = urls.judge_urls(pages, urls.RULES).collect()
    seen = np.zeros((2, urls.SYMBOLS**3), np.int64)
    for _, url in PAGES:
        verdict = _plain_rule(url)[3]
        if verdict:
            np.add.at(seen[int(verdict == "block")], _plain_grams(url), 1)
    weights = np.rint(urls.UNIT * urls.gram_weights(*seen)).astype(int)
    score = {url: sum(int(weights[g]) for g in _plain_grams(url)) / urls.UNIT / max(1, len(url or "")) for _, url in PAGES}
    bins = {"allow": Counter(), "block": Counter()}
    for _, url in PAGES:
        if verdict := _plain_rule(url)[3]:
            bins[verdict][max(-urls.BINS, min(urls.BINS, math.floor(score[url] / urls.BIN)))] += 1
    threshold = urls.best_threshold(bins["allow"], bins["block"])
    want = Counter()
    for page, url in PAGES:
        host, path, rule, verdict = _plain_rule(url)
        want[(page, host, path, rule, verdict or ("allow" if score[url] >= threshold else "block"))] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == want


def test_url_probabilities_sum_to_one():
    counts = np.random.default_rng(0).poisson(0.05, (urls.SYMBOLS,) * 3)
    assert np.allclose(np.exp(urls._log_probability(counts)).sum(-1), 1)


def test_url_filter_without_training(spark):
    pages = spark.createDataFrame([(1, "http://q.net/")], "page_id bigint, url string")
    assert [r.verdict for r in urls.judge_urls(pages, urls.RULES).collect()] == ["allow"]
    assert urls.judge_urls(pages.limit(0), urls.RULES).count() == 0


# --- search ---------------------------------------------------------------------------------


def _plain_top(rows, k):
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, a in whole:
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
            for rank, (score, i) in enumerate(scores[:k], 1):
                out[(q, rank, i, -score)] += 1
    return out


def test_search_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(search, "LEAST_BLOCK", 64)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(301)]
    rows += [(400, rows[5][1]), (401, rows[5][1]), (402, rows[5][1]), (402, rows[5][1])]  # ties and repeated rows
    rows += [(500, [1.0, 2.0]), (501, []), (600, None), (601, [None] * 12), (602, [math.nan] * 12), (603, [math.inf] * 12), (None, [1.0] * 12)]
    vectors = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id bigint, embedding array<float>, rank int, at int")
    got = search.top_k(vectors, F.col("vec_id") % 100 == 0).collect()
    assert Counter(map(tuple, got)) == _plain_top(rows, 10)


def test_search_with_few_candidates(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in search.top_k(vectors, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert search.top_k(vectors.limit(0), F.lit(True)).count() == 0


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    results = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, results[-1], SF_DIR).write.parquet(folder(str(k)))
        results.append(spark.read.parquet(folder(str(k))))
    assert all(r.columns == docs.columns for r in results[:-1])
    rows = [[tuple(r) for r in result.select("doc_id", "text").collect()] for result in results[:-1]]
    kept = dict(rows[1])
    assert sum(q == 0 and i in kept for i, q in labels.items()) <= 3
    assert sum(q == 1 and i not in kept for i, q in labels.items()) <= 3
    latest = {text: max(i for i, t in rows[1] if t == text) for text in kept.values()}
    assert Counter(rows[2]) == Counter((i, text) for text, i in latest.items())
    assert set(rows[3]) < set(rows[2]) and set(rows[4]) <= set(rows[3])
    packed = results[-1].where("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in packed} == Counter(i for i, _ in rows[4])


def odd_tables(spark, folder, rows):
    """A folder of tables with odd documents, with further columns named like those that stages make."""
    names = ["score", "copy", "shuffle_key", "id", "digest", "_gone", "path", "row", "label", "held_out"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema).withColumns({name: F.lit("x") for name in names})
    docs.coalesce(2).write.parquet(f"{folder('odd')}/documents.parquet")
    labels = [(i, int(i % 2 == 0), int(i % 3 == 0)) for i, *_ in rows if i is not None]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(f"{folder('odd')}/labels.parquet")
    return folder("odd")


def test_pipeline_on_odd_rows(spark, folder):
    words = [f"word{i}" for i in range(400)]
    good = lambda k: " ".join(words[k : k + 40])
    rows = [(i, good(8 * i) if i % 2 == 0 else "## %% && 00 !!", "en", "a", 1) for i in range(1, 30)]
    rows += [(None, good(1), None, None, None), (None, None, "en", "b", 0), (40, None, "en", "b", 0), (41, "", None, "b", 0), (42, "  ", "en", None, 0)]
    rows += [(50, good(2), "en", "a", 1)] * 2 + [(51, good(2), "en", "b", 1), (52, good(300) + " tail", "en", "b", 1), (53, good(300), "en", "b", 1)]
    rows += [(60, " ".join(words * 300), "en", "c", 1)]
    at = odd_tables(spark, folder, rows)
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, at).write.parquet(folder(f"stage{k}"))
        before, docs = docs, spark.read.parquet(folder(f"stage{k}"))
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
            found = Counter(tuple(r) for r in docs.select("doc_id", "text").collect())
            given = Counter(tuple(r) for r in before.select("doc_id", "text").collect())
            assert set(found) <= set(given)
        if k == 0:
            assert all(found[key] == given[key] for key in given if not (key[1] or "").split())
        if k == 1:
            assert Counter((t or "") for _, t in found) == Counter({t or "" for _, t in given})
        if k == 2:
            assert (60, rows[-1][1]) in found and sum(i in (52, 53) for i, _ in found) <= 1
    want = Counter(r.doc_id for r in before.collect())
    packed = docs.where("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in packed} == want
    assert docs.agg(F.max("length")).first()[0] <= 4096


def test_pipeline_on_an_empty_table(spark, folder):
    at = odd_tables(spark, folder, [])
    assert corpus_pipeline.run(spark, at).count() == 0
