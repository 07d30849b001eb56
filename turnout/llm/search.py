"""Exact search for the k nearest vectors, with bounds from segment means and deviations.

The inner product of two vectors follows from their lengths and their distance, so the best
scores are the least distances, each corrected by a candidate's own length. For a segment of m
components with means a, b and deviations s, t the squared distance is at least
``m * ((a - b)**2 + (s - t)**2)``. Summed over all segments this bounds a score from above,
tighter the shorter the segments. Candidates go through the bounds from coarse to fine; exact
scores are computed for those whose bound still reaches the k-th best score known.

Queries and candidates meet in blocks of bounded size, every query block with every candidate
block, each pair of blocks in a task of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Segments per vector, coarse to fine.
LEVELS = (1, 4, 16)
#: Most candidates and queries in a block, and queries that are bounded at once. What is shuffled
#: grows with the number of blocks, so they are large; while there are fewer blocks than keep all
#: cores busy, they are smaller, down to the least size.
BLOCK, QUERY_BLOCK, LEAST_BLOCK, AT_ONCE = 1 << 15, 1 << 13, 1 << 10, 64

_FOUND = "query_row bigint, query_id bigint, vec_id bigint, score bigint"
_ARROW_FOUND = pa.schema([(c.split()[0], pa.int64()) for c in _FOUND.split(", ")])


def _matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Integer vectors as rows; shorter ones are filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, times the root of its length."""
    bounds = np.linspace(0, vectors.shape[1], min(segments, max(1, vectors.shape[1])) + 1).astype(int)
    columns = []
    for a, b in zip(bounds, bounds[1:]):
        part = vectors[:, a:b].astype(float)
        mean = part.mean(axis=1) if b > a else np.zeros(len(part))
        deviation = part.std(axis=1) if b > a else np.zeros(len(part))
        columns += [mean * np.sqrt(b - a), deviation * np.sqrt(b - a)]
    return np.stack(columns, axis=1)


def _scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products; fails rather than wrap around."""
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(query).max(initial=0)) * len(query)
    if largest < 2**53:
        return (vectors.astype(float) @ query.astype(float)).astype(np.int64)
    if largest < 2**63:
        return vectors @ query
    return (vectors.astype(object) @ query.astype(object)).astype(np.int64)


def search_block(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """For each query the positions and scores of its best ``k`` vectors, its own id left out."""
    norms, query_norms = ((x.astype(float) ** 2).sum(axis=1) for x in (vectors, queries))
    stats = [segment_statistics(vectors, n) for n in LEVELS]
    query_stats = [segment_statistics(queries, n) for n in LEVELS]
    squares = [(s**2).sum(axis=1) for s in stats]
    query_squares = [(s**2).sum(axis=1) for s in query_stats]

    def bounds(level: int, of: slice | np.ndarray, q: int | slice) -> np.ndarray:
        """No score is above (|q|^2 + |v|^2 - least squared distance) / 2; a little is added for rounding."""
        cross = query_stats[level][q] @ stats[level][of].T
        here = np.expand_dims(query_squares[level][q], -1) if isinstance(q, slice) else query_squares[level][q]
        length = np.expand_dims(query_norms[q], -1) if isinstance(q, slice) else query_norms[q]
        least = here + squares[level][of] - 2 * cross
        return (length + norms[of] - least) / 2 + 1e-9 * (length + norms[of]) + 1e-3

    for first in range(0, len(queries), AT_ONCE):
        coarse = bounds(0, slice(None), slice(first, first + AT_ONCE))
        for q, bound in enumerate(coarse, first):
            bound[ids == query_ids[q]] = -np.inf
            others = np.flatnonzero(bound > -np.inf)
            if len(others) > 4 * k:
                likely = others[np.argpartition(bound[others], -4 * k)[-4 * k :]]
                reached = np.partition(_scores(vectors[likely], queries[q]), -k)[-k]
                others = others[bound[others] >= reached]
                for level in range(1, len(LEVELS)):
                    others = others[bounds(level, others, q) >= reached]
            scores = _scores(vectors[others], queries[q])
            best = np.lexsort((ids[others], -scores))[:k]
            yield q, others[best], scores[best]


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of each row where ``is_query``.

    Components count as ``floor(scale * x)``; scores are their integer inner products, ties go to
    the smaller id. Candidates are all rows but those with the query's own id. Rows with a null id
    or vector, or a component that is null or not finite, take no part. Repeated rows are
    candidates each, and repeated query rows get a result each. Shorter vectors count as if filled
    up with zeros; an empty vector scores 0. With fewer than ``k`` candidates all are returned.
    """
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(scale * x.cast("double")))
    # Numbering by place in the input spreads repeated rows over blocks like any others.
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("at"),
    )
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    busy = 4 * vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // BLOCK), min(busy, -(-n // LEAST_BLOCK)))
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    candidates = rows.select("vec_id", "v", (F.col("at") % blocks).alias("block"), each(query_blocks).alias("query_block"))
    queries = rows.where("asks").select(
        F.col("vec_id").alias("query_id"), "v", "at", (F.col("at") % query_blocks).alias("query_block"),
        each(blocks).alias("block"),
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            width = max(_matrix(t["v"]).shape[1] for t in (left, right))
            ids, query_ids = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
            at = right["at"].to_numpy()
            for q, best, scores in search_block(_matrix(left["v"], width), ids, _matrix(right["v"], width), query_ids, k):
                found += [(at[q], query_ids[q], i, s) for i, s in zip(ids[best].tolist(), scores.tolist())]
        columns = zip(*found) if found else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=_ARROW_FOUND)

    keys = ["block", "query_block"]
    found = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(meet, _FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
