"""Exact deduplication: a keyed stream whose state outlives every batch, then a check of bytes.

The stream's state lives in RocksDB and never expires. It holds, for each digest, how many rows
had it, the identifier of the row that stays, and where that row's content is (file and row in
it). Rows whose digest was there before are hits; the full texts of hits are compared.

Everything is DataFrame functions, so it all runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.sinks import shared_dir
from turnout.streaming import stream_session

_STAGED = "id bigint, digest binary, path string, row bigint"


def sha256(text: Column) -> Column:
    """The 32 bytes of a text's SHA-256."""
    return F.unhex(F.sha2(text, 256))


def _digested(docs, id_col, text_col, digest) -> DataFrame:
    """Identifier, digest and content locator of each row; reads the texts once."""
    place = docs.metadataColumn("_metadata")
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        digest(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"),
        place["file_path"].alias("path"),
        place["row_index"].alias("row"),
    )


def update_state(spark: SparkSession, staged: str, checkpoint: str) -> DataFrame:
    """Fold the digests that came to ``staged`` since the last call into the state; its content.

    A second call with the same checkpoint goes on where the first ended: new files only, against
    all digests ever seen. Repeated copies are counted in each task before the shuffle, so a
    text that makes up a third of all rows reaches its state as one row per task.
    """
    session = stream_session(spark)
    # One batch and the run is over: executors give a store's memory back when it is done.
    session.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    seen = (
        session.readStream.schema(_STAGED)
        .parquet(staged)
        .groupBy("digest")
        .agg(F.max(F.struct("id", "path", "row")).alias("kept"), F.count(F.lit(1)).alias("n"))
    )
    query = (
        seen.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    state = session.read.format("statestore").load(checkpoint)
    kept, count = (F.col("value").getField(name) for name in ("max", "count"))
    return state.select(F.col("key.digest").alias("digest"), kept.alias("kept"), count.alias("n"))


def _collided(docs, groups, text_col, digest) -> DataFrame:
    """Digests of hits under which there is more than one text, by their full bytes."""
    hits = groups.where("n > 1").select("digest").hint("shuffle_hash")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(text.alias("text"), digest(text).alias("digest"))
    # Equal texts collapse in each task before they move again.
    distinct = texts.join(hits, "digest", "left_semi").select("text").distinct()
    return distinct.groupBy(digest(F.col("text")).alias("digest")).count().where("count > 1").select("digest")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """The group of every row: ``id, keep_id, group_size, kept, digest, path, row``.

    ``docs`` must be read from files, since rows are told apart by their place. Of rows with equal
    texts the one with the largest id stays; among rows that repeat an id, the one latest by file
    and row; a null id comes before all others. A null text counts as empty, and empty texts are
    equal. An empty table gives an empty result. Texts compare by all their bytes, whatever their
    length. Should two texts share a digest, each gets its own group.
    """
    spark = docs.sparkSession
    root = shared_dir(spark, "exact-dedup")
    staged, groups_at, collided_at = f"{root}/digests", f"{root}/groups", f"{root}/collided"
    _digested(docs, id_col, text_col, digest).write.parquet(staged)
    update_state(spark, staged, f"{root}/state").write.parquet(groups_at)
    groups = spark.read.parquet(groups_at)
    _collided(docs, groups, text_col, digest).write.parquet(collided_at)
    collided = spark.read.parquet(collided_at)
    rows = spark.read.schema(_STAGED).parquet(staged)
    here = F.struct("id", "path", "row")
    if collided.isEmpty():
        joined = rows.join(groups, "digest")
        return _marked(joined, here)
    settled = _marked(rows.join(groups.join(collided, "digest", "left_anti"), "digest"), here)
    return settled.unionByName(_by_text(docs, collided, id_col, text_col, digest, here))


def _marked(joined: DataFrame, here: Column) -> DataFrame:
    return joined.select(
        "id",
        F.col("kept.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        here.eqNullSafe(F.col("kept")).alias("kept"),
        "digest",
        "path",
        "row",
    )


def _by_text(docs, collided, id_col, text_col, digest, here) -> DataFrame:
    """The rows under collided digests, grouped by their texts."""
    place = docs.metadataColumn("_metadata")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), text.alias("text"), digest(text).alias("digest"),
        place["file_path"].alias("path"), place["row_index"].alias("row"),
    ).join(collided, "digest", "left_semi")
    best = rows.groupBy("digest", "text").agg(F.max(here).alias("kept"), F.count(F.lit(1)).alias("n"))
    return _marked(rows.join(best, ["digest", "text"]), here)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` does not keep; all columns stay."""
    spark = docs.sparkSession
    dropped = exact_dedup(docs, id_col, text_col).where("not kept").select("path", "row")
    at = f"{shared_dir(spark, 'exact-dedup')}/dropped"
    dropped.write.parquet(at)
    place = docs.metadataColumn("_metadata")
    gone = spark.read.parquet(at)
    return docs.join(
        gone, (place["file_path"] == gone["path"]) & (place["row_index"] == gone["row"]), "left_anti"
    )
