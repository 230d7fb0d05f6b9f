"""Exact top-k inner-product search with block-at-a-time pruning.

Rows are dealt to shards, and a shard is cut into small document-range blocks
(runs of its ids in order).  A block keeps, per component ("term"), the least and greatest value, and a
forward index (its rows' components as one matrix).  A query's bound on a
block is the sum over its terms of weight times term maximum (minimum for
negative weights).  Per query the blocks are taken by falling bound and scored
through the forward index until the bound falls below the k-th score so far,
so no row that could enter the result is missed.

Distribution: a grid of query tiles and row shards, both of bounded size, meet
by an equi-join on the cell; each cell yields k rows a query, and the k best of
those are chosen per query.  Memory of a task is one tile plus one shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import materialize, read_table

#: Rows of a shard at most, queries of a tile, rows of a block inside a shard.
SHARD_ROWS, TILE_QUERIES, BLOCK_ROWS = 65536, 4096, 128
#: Smaller tables are cut into 64 shards, but none smaller than this.
LEAST_SHARD_ROWS = 1024
#: Up to this absolute value, products of 64 terms and far more stay exact in float64.
EXACT = 1 << 22


def quantize(vector: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` for every component; null if the vector is null or holds a null or non-finite component."""
    values = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & fit, values)


def search_cell(queries: pd.DataFrame, rows: pd.DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> pd.DataFrame:
    """The k best of one shard for every query of one tile."""
    empty = pd.DataFrame({"query_id": [], "query_copy": [], "vec_id": [], "copy": [], "score": []}).astype("int64")
    if queries.empty or rows.empty:
        return empty
    rows = rows.sort_values(["vec_id", "copy"], kind="stable")
    width = max(max(map(len, rows["v"])), max(map(len, queries["v"])))

    def dense(vectors) -> np.ndarray:
        out = np.zeros((len(vectors), max(width, 1)), dtype=np.float64)
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return out

    q, m = dense(queries["v"]), dense(rows["v"])
    big = max(np.abs(q).max(), np.abs(m).max()) > EXACT
    if big:  # exact integers of any size; scores outside 64 bits are clipped
        q_int = [[int(x) for x in v] for v in queries["v"]]
        m_int = [[int(x) for x in v] for v in rows["v"]]
    ids, copies = rows["vec_id"].to_numpy(), rows["copy"].to_numpy()
    first = np.arange(0, len(rows), block_rows)
    top, low = np.maximum.reduceat(m, first), np.minimum.reduceat(m, first)
    bounds = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    if big:
        bounds += np.abs(bounds) * 1e-9
    order = np.argsort(-bounds, axis=1, kind="stable")
    out = []
    for i, (own, own_copy) in enumerate(zip(queries["query_id"], queries["query_copy"], strict=True)):
        best: list[tuple] = []
        kth = None
        for b in order[i]:
            if kth is not None and bounds[i, b] < kth:
                break
            at = slice(first[b], first[b] + block_rows)
            if big:
                score = np.array(
                    [max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(q_int[i], v, strict=False)))) for v in m_int[at]],
                    dtype=np.int64,
                )
            else:
                score = (m[at] @ q[i]).astype(np.int64)
            other = (ids[at] != own) | (copies[at] != own_copy)
            if kth is not None:
                other &= score >= kth
            hit = np.flatnonzero(other)
            if len(hit) > k:
                hit = hit[np.lexsort((copies[at][hit], ids[at][hit], -score[hit]))[:k]]
            best += [(-int(score[j]), int(ids[at][j]), int(copies[at][j])) for j in hit]
            best.sort()
            del best[k:]
            if len(best) == k:
                kth = -best[-1][0]
        out += [(own, own_copy, vec, copy, -negative) for negative, vec, copy in best]
    return pd.DataFrame(out, columns=list(empty.columns)).astype("int64") if out else empty


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, shard_rows: int = SHARD_ROWS, tile_queries: int = TILE_QUERIES
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of every query row.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition
    on ``vec_id``.  Vectors that are null or hold null or non-finite components, and
    rows without an id, take no part.  Vectors of different lengths meet as if padded
    with zeros; ties go to the smaller id.  A repeated ``vec_id`` is a row
    of its own: it is a candidate for its copy but not for itself.  Scores beyond 64 bits
    are clipped.  An empty table gives an empty result."""
    rows = vectors.select("vec_id", quantize(F.col("embedding")).alias("v")).where("vec_id is not null and v is not null")
    repeated = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(repeated, "vec_id")
    copy = F.row_number().over(Window.partitionBy("vec_id").orderBy("v"))
    rows = materialize(rows.withColumn("copy", copy).select(F.col("vec_id").cast("long").alias("vec_id"), "copy", "v"), "topk-rows")
    n = rows.count()
    queries = rows.where(is_query)
    n_queries = queries.count()
    shard_rows = min(shard_rows, max(LEAST_SHARD_ROWS, n // 64))
    shards, tiles = max(1, -(-n // shard_rows)), max(1, -(-n_queries // tile_queries))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards))
    tile = F.pmod(F.xxhash64("vec_id", "copy"), F.lit(tiles))
    left = (
        queries.withColumn("tile", tile)
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .select((F.col("tile") * shards + F.col("shard")).alias("cell"), F.col("vec_id").alias("query_id"), F.col("copy").cast("long").alias("query_copy"), "v")
    )
    right = (
        rows.withColumn("shard", shard)
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
        .select((F.col("tile") * shards + F.col("shard")).alias("cell"), "vec_id", F.col("copy").cast("long").alias("copy"), "v")
    )

    def cell(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return search_cell(a, b, k)

    found = (
        left.groupBy("cell")
        .cogroup(right.groupBy("cell"))
        .applyInPandas(cell, "query_id long, query_copy long, vec_id long, copy long, score long")
    )
    best = Window.partitionBy("query_id", "query_copy").orderBy(F.col("score").desc(), "vec_id", "copy")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def op7_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(c.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
