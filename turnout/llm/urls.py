"""URL filter: rules first, then two character language models against each other.

URLs that a rule allows or blocks train one Markov model each. A model's order varies with what
it has seen: contexts of two characters are smoothed with shorter ones (Witten-Bell). A URL that
no rule fits is judged by the difference of its log-likelihoods under the two models divided by
its length, against the threshold that separates the training URLs best. The models come down to
one weight per three characters, a table of fixed size, so URLs are scored without a shuffle.

Everything on executors is DataFrame functions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Symbols told apart, the start of a URL last; every other character is symbol 0.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-:?=&_#%" + "\x01"
SYMBOLS, START = len(ALPHABET) + 1, len(ALPHABET)
#: Scores are counted in bins of this width up to this size when the threshold is chosen.
BIN, BINS = 0.01, 500
#: Weights are kept in this fraction of a natural log.
UNIT = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: verdict, host and path of each rule of the registered query
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def first_fit(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls; of equally long ones a block, then by text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, under in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r[1:])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(under)
        rule, verdict = F.when(fits, of + under).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def grams(url: Column) -> Column:
    """For each character of a URL, the number of it and the two symbols before it."""
    text = F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER)
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    codes = F.transform(characters, lambda c: F.instr(F.lit(ALPHABET), c))
    padded, n = F.concat(F.array(F.lit(START), F.lit(START)), codes), F.size(codes)
    step = lambda ahead, code: ahead * SYMBOLS + code
    two = F.zip_with(F.slice(padded, F.lit(1), n), F.slice(padded, F.lit(2), n), step)
    return F.zip_with(two, codes, step)


def _log_probability(counts: np.ndarray) -> np.ndarray:
    """Log-probability of each third symbol after each two, from counts of all three."""
    single = counts.sum((0, 1))
    estimate = (single + 1.0) / (single.sum() + SYMBOLS)
    for table in (counts.sum(0), counts):
        total, kinds = table.sum(-1, keepdims=True), (table > 0).sum(-1, keepdims=True)
        mixed = (table + kinds * estimate) / np.maximum(total + kinds, 1)
        estimate = np.where(total > 0, mixed, np.broadcast_to(estimate, table.shape))
    return np.log(estimate)


def gram_weights(allowed: np.ndarray, blocked: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each gram; all 0 unless there are URLs of both kinds."""
    if not (allowed.any() and blocked.any()):
        return np.zeros(SYMBOLS**3)
    shape = (SYMBOLS, SYMBOLS, SYMBOLS)
    return (_log_probability(allowed.reshape(shape)) - _log_probability(blocked.reshape(shape))).reshape(-1)


def best_threshold(allowed: dict[int, int], blocked: dict[int, int]) -> float:
    """The score from which on URLs are allowed: the middle of the range with the least balanced error."""
    if not (allowed and blocked):
        return 0.0
    edges = range(-BINS, BINS + 2)
    n_allowed, n_blocked = sum(allowed.values()), sum(blocked.values())
    below, reached, errors = 0, n_blocked, []
    for edge in edges:
        errors.append(below / n_allowed + reached / n_blocked)
        below, reached = below + allowed.get(edge, 0), reached - blocked.get(edge, 0)
    best = [edge for edge, error in zip(edges, errors) if error == min(errors)]
    run = [edge for i, edge in enumerate(best) if edge == best[0] + i]
    return BIN * (run[0] + run[-1]) / 2


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row of ``pages``.

    A null url has neither host nor path nor score evidence: its score is 0, like that of an empty
    one. Repeated rows count each, in training and in the result. If the rules find no URLs to
    allow or none to block, all others are allowed. ``rules`` is a short list, part of the plan.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(
        F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(url_col).alias("url")
    )
    rule, ruling = first_fit(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", rule.alias("rule"), ruling.alias("ruling"))
    training = ruled.where("rule IS NOT NULL")

    # One row per gram that occurs, of SYMBOLS**3, comes to the driver.
    counts = training.select("ruling", F.explode(grams(F.col("url"))).alias("gram")).groupBy("gram").agg(
        F.count_if(F.col("ruling") == "allow").alias("allowed"), F.count_if(F.col("ruling") == "block").alias("blocked")
    )
    seen = np.zeros((2, SYMBOLS**3), np.int64)
    for gram, allowed, blocked in counts.collect():
        seen[:, gram] = allowed, blocked
    weights = gram_weights(*seen)

    # The weights are a constant of the plan, folded once into an array. Whole numbers keep sums exact.
    model = F.split(F.lit(" ".join(str(w) for w in np.rint(UNIT * weights).astype(int))), " ").cast("array<int>")
    total = F.aggregate(grams(F.col("url")), F.lit(0).cast("bigint"), lambda s, g: s + F.get(model, g)) / UNIT
    n = F.greatest(F.length(F.coalesce("url", F.lit(""))), F.lit(1))

    scored = ruled.withColumn("score", total / n)
    bin_of = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") / BIN))).cast("int")
    bins: dict[str, dict[int, int]] = {"allow": {}, "block": {}}
    in_bins = scored.where("rule IS NOT NULL").groupBy("ruling", bin_of.alias("bin")).count()
    for kind, at, n_urls in in_bins.collect():  # at most two rows per bin
        bins[kind][at] = n_urls
    threshold = best_threshold(bins["allow"], bins["block"])
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruling", by_model).alias("verdict"), "score")
