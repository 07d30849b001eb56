"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes the rows that its predecessor kept, written as Parquet and read again, and its
decisions take effect. All but the last return the columns of ``documents``.

Null and empty texts are not judged for their quality, are equal to each other, near to nothing,
and pack as an end id alone. Rows that repeat an id count each; of equal texts one row stays. A
null id never comes before others, and a null source is a source. Texts are taken whole, however
long. Further columns of ``documents`` are left out, whatever their names; an empty table passes
through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.llm import dedup, jaccard, mixing, packing, quality
from turnout.sinks import shared_dir
from turnout.sources import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Documents that score less go: even odds, since both labels count alike in training. Thresholds
#: from 0.2 to 0.7 gave the same on held-out documents, see the README.
LEAST_QUALITY = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects; empty texts are not judged."""
    labels = read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, F.lit(True))
    return quality.keep_good(docs, model, LEAST_QUALITY).select(COLUMNS)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return dedup.drop_exact_copies(docs).select(COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of documents linked by five-word shingles at a similarity of 0.8 or more."""
    return jaccard.one_of_each_group(docs, width=5, percent=80).select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at equal weights, each document as often as its source needs, in a random order."""
    return mixing.mix(docs).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place in sequences of 4096 tokens, with the ids of its pieces."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("exact dedup", without_exact_copies),
    ("near dedup", without_near_copies),
    ("source mix", mixed),
    ("packing", packed),
]

#: A trained classifier and greedy packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder and read again."""
    docs, root = read_table(spark, sf_dir, "documents"), shared_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
