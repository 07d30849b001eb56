"""The registered queries of this package, each over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.llm import (
    collocations,
    dedup,
    jaccard,
    lexical,
    lm,
    mixing,
    packing,
    quality,
    rans,
    search,
    secret_scan,
    toxicity,
    urls,
)
from turnout.llm.labelled import remainder
from turnout.sinks import shared_dir
from turnout.sources import read_table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = quality.fit(docs, labels, ~held_out)
    return _judged(quality.score(docs, model), held_out, 0.7)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels, ~held_out)
    return _judged(toxicity.score(docs, model), held_out, 0.5)


def _judged(scored: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    rans.write_ids(read_table(spark, sf_dir, "documents"), path)
    docs = rans.read_ids(spark, path)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(read_table(spark, sf_dir, "documents"), width=4, percent=85, screened=False)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(read_table(spark, sf_dir, "pages"), urls.RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read_table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) == 2)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources alike, as many documents as there are."""
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.exact_dedup(read_table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(read_table(spark, sf_dir, "documents"), shared_dir(spark, "lexical-index"))
    return lexical.rank(index, read_table(spark, sf_dir, "benchmark"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["number"] < len(secret_scan.BASE_KINDS))
    counts = [
        F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")  # noqa: B023
        for kind in secret_scan.BASE_KINDS
    ]
    return rows.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("found")).alias("spans"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


_OP8 = """
WITH sources AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (SELECT sum(n) FROM sources) / (SELECT count(*) FROM sources)::DOUBLE / n AS rate FROM sources),
terms AS (
  SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
  FROM rates, range(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT) + 1) AS t(k)
),
cumulative AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
hashed AS (
  SELECT *, CAST(('0x' || substr(sha256('mix-1-' || coalesce(doc_id::VARCHAR, 'null')), 1, 13)) AS UBIGINT)
            / 4503599627370496.0::DOUBLE AS u
  FROM documents
),
counted AS (
  SELECT h.doc_id, h.text, h.lang, h.source, h.n_chars,
         (SELECT count(*) FROM cumulative c WHERE c.source IS NOT DISTINCT FROM h.source AND c.c <= h.u) AS copies
  FROM hashed h
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       sha256('mix-order-' || coalesce(doc_id::VARCHAR, 'null') || '-' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted)"""

_OP9 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


_OP10 = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 10"""

# What terms are made of, and A-Z lower-cased.
_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP11 = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY ALL),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
sizes AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // terms AS m FROM lengths, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, totals GROUP BY term, docs
),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN postings USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50"""


def _op12() -> str:
    """Matches by what lies between them; entropy of every window by its own counts."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"

    def matches(kind: str, number: int, pattern: str, value: int = 0, least: int = 0) -> str:
        whole, gaps = f"regexp_extract_all(text, {quoted(pattern)})", f"regexp_split_to_array(text, {quoted(pattern)})"
        values = f"regexp_extract_all(text, {quoted(pattern)}, {value})"
        return f"""(SELECT doc_id, {number} AS number, '{kind}' AS kind, start, match FROM (
          SELECT doc_id, m[i] AS match, v[i] AS value, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start
          FROM (SELECT doc_id, {whole} AS m, {values} AS v, {gaps} AS g FROM texts), unnest(range(1, len(m) + 1)) AS t(i)
        ) WHERE length(value) >= {least})"""

    base = [("assign", secret_scan.ASSIGN, 2, secret_scan.LEAST_VALUE), ("access", secret_scan.ACCESS, 0, 0), ("hex", secret_scan.HEX, 0, 0)]
    plain = " UNION ALL ".join(matches(kind, n, *rest) for n, (kind, *rest) in enumerate(base))
    runs = " UNION ALL ".join(matches(of.kind, len(base) + n, of.pattern) for n, of in enumerate(secret_scan.CLASSES))
    limits = ", ".join(f"('{of.kind}', {of.window}, {of.most})" for of in secret_scan.CLASSES)
    allowed = " OR ".join(f"regexp_matches(match, {quoted(pattern)})" for pattern in secret_scan.ALLOWED)
    logs = ", ".join(map(str, secret_scan.LOGS))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS (SELECT doc_id, number, kind, start, start + length(match) AS stop FROM ({plain})),
classes(kind, size, most) AS (VALUES {limits}),
candidates AS (SELECT * FROM ({runs}) JOIN classes USING (kind) WHERE NOT ({allowed})),
windows AS (
  SELECT doc_id, number, kind, start, size, place FROM candidates, unnest(range(0, length(match) - size + 1)) AS t(place)
  WHERE list_sum(list_transform(map_values(list_histogram(string_split(substr(match, place + 1, size), ''))),
                                lambda n: ([{logs}])[CAST(n AS BIGINT) + 1])) <= most
),
marked AS (
  SELECT *, CAST(coalesce(place - lag(place) OVER run > size, true) AS INTEGER) AS fresh FROM windows
  WINDOW run AS (PARTITION BY doc_id, kind, start ORDER BY place)
),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, kind, start ORDER BY place) AS island FROM marked),
dense AS (
  SELECT doc_id, number, kind, start + min(place) AS start, start + max(place) + size AS stop
  FROM islands GROUP BY doc_id, number, kind, islands.start, size, island
),
spans AS (
  SELECT doc_id, number, start, kind || ':' || start || ':' || stop AS span
  FROM (SELECT * FROM base UNION ALL SELECT doc_id, number, kind, start, stop FROM dense)
),
joined AS (
  SELECT doc_id, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access,
         count(*) FILTER (number = 2) AS n_hex, string_agg(span, ',' ORDER BY start, number) FILTER (number < 3) AS base,
         string_agg(span, ',' ORDER BY start, number) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (doc_id)"""


_OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
runs AS (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM split, unnest([1, 2, 3, 4]) AS s(size), unnest(range(1, len(words) - size + 2)) AS t(i)
),
counts AS (SELECT lang, size, phrase, count(*) AS a FROM runs GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE size > 1 AND a >= 30),
inside AS (
  SELECT DISTINCT lang, array_to_string(words[i:i + short - 1], ' ') AS phrase, phrase AS longer, a AS covering
  FROM candidates, unnest([2, 3]) AS s(short), unnest(range(1, size - short + 2)) AS t(i) WHERE short < size
),
kept AS (
  SELECT c.* FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * covering >= 80 * c.a)
),
cuts AS (
  SELECT k.lang, k.phrase, k.a, cut, l.a AS l, r.a AS r,
         CAST(2000000::HUGEINT * k.a // (l.a + r.a) AS BIGINT) AS score
  FROM kept k, unnest(range(1, size)) AS t(cut)
  JOIN counts l ON l.lang = k.lang AND l.phrase = array_to_string(words[1:cut], ' ')
  JOIN counts r ON r.lang = k.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored JOIN totals USING (lang) QUALIFY rank <= 2000"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_toxicity": op2_toxicity,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op6_token_files": op6_token_files,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_url_filter": op5_url_filter,
        "op7_lm_scores": op7_lm_scores,
        "op8_source_mix": op8_source_mix,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_top_k": op10_top_k,
        "op11_lexical_rank": op11_lexical_rank,
        "op12_secret_scan": op12_secret_scan,
        "op13_collocations": op13_collocations,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_source_mix": _OP8,
        "op9_exact_dedup": _OP9,
        "op10_top_k": _OP10,
        "op11_lexical_rank": _OP11,
        "op12_secret_scan": _op12(),
        "op13_collocations": _OP13,
    }
