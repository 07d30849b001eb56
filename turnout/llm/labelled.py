"""A bounded sample of labelled documents, the only rows that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, of: int) -> Column:
    """``crc32(id as text) mod of``; 0 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % of, F.lit(0))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, trainable: Column, most: int,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``label, text`` of at most ``most`` labelled documents, chosen by a hash of their ids.

    Rows whose label is neither 0 nor 1 or whose id is null are left out. ``trainable`` is a
    condition on the id. Chosen ids without a document, or with several, give no or several rows.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & trainable)
        .groupBy(F.col(id_col).alias("chosen")).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("chosen"), "chosen").limit(most)
    )
    texts = docs.select(F.col(id_col).alias("chosen"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(chosen.hint("broadcast"), "chosen").select("label", "text")
