"""Mixing sources to target weights by Poisson replication.

Each document is repeated a Poisson-distributed number of times whose mean is the rate that its
source needs to reach its weight. The number comes from inverting the distribution at a uniform
number hashed from a seed and the document's id, so it does not depend on partitions, order or
retries. The copies are then put in an order hashed from seed, id and copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnout.sinks import shared_dir

#: Higher rates are sums of parts of at most this rate, each with a number of its own.
MOST_RATE = 256.0


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of the SHA-256 of the parts joined with ``-``."""
    text = F.concat_ws("-", *(F.coalesce(F.expr(f"'{p}'") if isinstance(p, str) else p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _cumulative(rate: Column) -> Column:
    """P(N <= k) for k = 0, 1, ... as far as a double can tell it from 1."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20)
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))

    def extend(done, k):
        p = done["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(done["c"], F.array(F.element_at(done["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1).cast("bigint"), last), start, extend, lambda done: done["c"])


def source_rates(docs: DataFrame, weights: DataFrame | None, source_col: str, total: int | None) -> DataFrame:
    """``source, rate``: the mean number of copies of each document of a source."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighted = counts.withColumn("weight", F.lit(1.0))
    else:
        given = weights.select(F.col("source").alias("of"), F.col("weight").cast("double"))
        weighted = counts.join(given, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        weighted = weighted.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    sums = weighted.agg(F.sum("n"), F.sum("weight")).first()
    size, weight = total if total is not None else sums[0] or 0, sums[1] or 1.0
    return weighted.select("source", (F.lit(float(size)) * F.col("weight") / weight / F.col("n")).alias("rate"))


def mix(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None, seed: str = "mix",
        id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """All columns of ``docs``, ``copy`` (from 1) and ``shuffle_key``, in the order of the key.

    ``weights`` has ``source, weight``, each source once; without it all sources weigh the same. A
    source that is not in it weighs 0. A null source is a source. ``total`` is the expected number
    of rows that come out, by default as many as went in. Rows that repeat an id get the same
    number of copies; a null id is hashed like the text ``null``. Texts are not looked at. Columns
    of ``docs`` named like the two new ones are replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    at = f"{shared_dir(spark, 'mixing')}/rates"
    rates = source_rates(docs, weights, source_col, total)
    parts = F.greatest(F.ceil(F.col("rate") / MOST_RATE), F.lit(1).cast("bigint"))
    rates.select("source", parts.alias("parts"), _cumulative(F.col("rate") / parts).alias("cumulative")).write.parquet(at)
    # Written, the table has a size that Spark knows; it is broadcast only if it is small.
    known = spark.read.parquet(at)
    columns = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    doc = docs.select(F.struct(*columns).alias("doc"), F.col(source_col).alias("of"), F.col(id_col).alias("id"))
    joined = doc.join(known, F.col("of").eqNullSafe(F.col("source")))
    number = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), F.col("parts")),
        F.lit(0),
        lambda n, part: n + F.size(F.filter("cumulative", lambda c: c <= uniform(seed, part, F.col("id")))),
    )
    # A row with 0 copies explodes to nothing.
    copies = joined.withColumn("copy", F.explode(F.slice(F.sequence(F.lit(0), number), 2, number)))
    keyed = copies.withColumn("shuffle_key", F.sha2(F.concat_ws("-", F.lit(seed), F.lit("order"), F.coalesce(F.col("id").cast("string"), F.lit("null")), "copy"), 256))
    # Dealt by ranges of the key, so the order goes on from one partition to the next.
    return keyed.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key").select("doc.*", "copy", "shuffle_key")
