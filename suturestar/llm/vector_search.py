"""Exact top-k inner products with a vector-approximation file.

The file holds, for every vector, one small cell number per dimension beside the exact integer components.  Cells
are equally wide between a dimension's extremes over all vectors.  A search takes the queries in blocks of at most
QUERY_BLOCK, which is what makes broadcasting a block safe; every task scans its part of the file:

1. cells alone give each pair an upper and a lower bound of the inner product;
2. pairs whose upper bound is below the query's k-th best so far, by lower bounds or exact scores, are out;
3. the exact vectors of the rest are read best bound first, a few per query at a time, until the k-th exact score
   is above every bound that is left.

A task sends k rows per query at most, so thousands of copies of one vector add nothing, and ties go to the smaller id.

Vectors that are null or empty, or hold a null, NaN or infinite component take no part, neither do vectors with a
null id.  Vectors of another length than the query are no candidates.  Equal query rows are answered once; a
candidate with the query's own id is left out.  Components must stay below 2**28 after scaling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from suturestar.llm.frames import kept, read
from suturestar.session import scratch

K = 5
SCALE = 256
BITS = 6
QUERY_BLOCK = 2048
SCAN_ROWS = 2048
VECTOR = "id long, dim int, exact binary"
FILE = "id long, dim int, exact binary, cells binary"
HIT = "query int, query_id long, vec_id long, score long"
LEAST = np.iinfo(np.int64).min


def _integers(scale: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scaled integer components of the vectors that take part."""
    for batch in batches:
        ids, vectors = batch.column("id").to_pylist(), batch.column("vector")
        keep_id, keep_dim, keep = [], [], []
        for i, row in zip(ids, vectors):
            if i is None or not row.is_valid or not len(row.values):
                continue
            x = np.floor(scale * row.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if np.isfinite(x).all():
                keep_id.append(i)
                keep_dim.append(len(x))
                keep.append(x.astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keep_id, pa.int64()), pa.array(keep_dim, pa.int32()), pa.array(keep, pa.binary())],
            names=["id", "dim", "exact"],
        )


def integers(df: DataFrame, id_: str, vector: str, scale: int = SCALE) -> DataFrame:
    rows = df.select(F.col(id_).cast("long").alias("id"), F.col(vector).alias("vector"))
    return rows.mapInArrow(lambda it: _integers(scale, it), VECTOR)


def _matrix(column: pa.Array, rows: np.ndarray, dim: int, dtype: str) -> np.ndarray:
    """The blobs of the given rows as one matrix."""
    return np.frombuffer(b"".join(column.take(pa.array(rows)).to_pylist()), dtype).reshape(len(rows), dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims).tolist():
        yield d, np.flatnonzero(dims == d)


def _extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for d, rows in _by_dim(batch):
            x = _matrix(batch.column("exact"), rows, d, "<i4")
            low, high = seen.get(d, (x[0], x[0]))
            seen[d] = (np.minimum(low, x.min(0)), np.maximum(high, x.max(0)))
    for d, (low, high) in seen.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(low), pa.array(high)],
            names=["dim", "at", "low", "high"],
        )


Grid = dict[int, tuple[np.ndarray, np.ndarray]]


def grid(vectors: DataFrame, bits: int = BITS) -> Grid:
    """For each vector length the lowest value and the cell width of every dimension."""
    parts = vectors.select("dim", "exact").mapInArrow(_extremes, "dim int, at int, low int, high int")
    rows = parts.groupBy("dim", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim", "at").collect()
    out: Grid = {}
    for d in sorted({r.dim for r in rows}):
        low = np.array([r.low for r in rows if r.dim == d], np.float64)
        high = np.array([r.high for r in rows if r.dim == d], np.float64)
        out[d] = (low, np.maximum((high - low + 1) / (1 << bits), 1e-9))
    return out


def _cells(g: Grid, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells: list[bytes] = [b""] * batch.num_rows
        for d, rows in _by_dim(batch):
            low, width = g[d]
            c = ((_matrix(batch.column("exact"), rows, d, "<i4") - low) / width).astype(np.uint8)
            for i, row in zip(rows.tolist(), c):
                cells[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.binary())], names=[*batch.schema.names, "cells"])


class _Best:
    """The k best candidates of every query so far, by score and then the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.kth = np.full(n, LEAST)

    def add(self, query: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        q, s, i = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, id_)))
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top = rank < self.k
        self.query, self.score, self.id = q[top], s[top], i[top]
        full = rank[top] == self.k - 1
        self.kth[self.query[full]] = self.score[full]


def _search(queries: dict, g: Grid, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The k best of one part of the file for each query of a block."""
    best = {d: _Best(len(ids), k) for d, (_, ids, _) in queries.items()}
    for batch in batches:
        all_ids = batch.column("id").to_numpy()
        for d, rows in _by_dim(batch):
            if d not in queries:
                continue
            _, query_ids, q = queries[d]
            low, width = g[d]
            q32, reach = q.astype(np.float32), np.abs(q) @ (width / 2)
            for at in range(0, len(rows), SCAN_ROWS):
                part = rows[at : at + SCAN_ROWS]
                middle = low + (_matrix(batch.column("cells"), part, d, "u1") + 0.5) * width
                guess = (middle.astype(np.float32) @ q32.T).T
                # The middles are exact to half a cell; single precision adds less than this.
                slack = reach + 1 + 1e-5 * np.linalg.norm(q, axis=1) * np.sqrt((middle**2).sum(1).max())
                own = query_ids[:, None] == all_ids[part][None, :]
                guess[own] = -np.inf
                limit = best[d].kth.astype(np.float64)
                if guess.shape[1] >= k:
                    by_bounds = -np.partition(-guess, k - 1, axis=1)[:, k - 1] - slack
                    limit = np.maximum(limit, by_bounds)
                query, cand = np.nonzero((guess >= (limit - slack)[:, None]) & ~own)
                _read_exact(best[d], query, guess[query, cand] + slack[query], part[cand], q, batch, all_ids, d, k)
    for d, b in best.items():
        number, query_ids, _ = queries[d]
        columns = [pa.array(number[b.query], pa.int32()), pa.array(query_ids[b.query]), pa.array(b.id), pa.array(b.score)]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "query_id", "vec_id", "score"])


def _read_exact(best: _Best, query, bound, row, q, batch, all_ids, d: int, k: int) -> None:
    """Exact scores in the order of the bounds, until no bound left reaches the k-th score."""
    order = np.lexsort((-bound, query))
    query, bound, row = query[order], bound[order], row[order]
    step = k
    while len(query):
        now = np.arange(len(query)) - np.searchsorted(query, query) < step
        rows, back = np.unique(row[now], return_inverse=True)
        exact = _matrix(batch.column("exact"), rows, d, "<i4").astype(np.int64)
        score = np.einsum("ij,ij->i", exact[back], q[query[now]])
        best.add(query[now], score, all_ids[row[now]])
        query, bound, row = query[~now], bound[~now], row[~now]
        open_ = bound >= best.kth[query]
        query, bound, row = query[open_], bound[open_], row[open_]
        step *= 2


def top_k(vectors: DataFrame, is_query: Column, id_: str, vector: str, k: int = K, scale: int = SCALE) -> DataFrame:
    """Each query's k best candidates among all vectors: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    exact = integers(vectors, id_, vector, scale)
    g = grid(exact)
    file = kept(exact.mapInArrow(lambda it: _cells(g, it), FILE), "va-file")
    asked = file.filter(is_query).select("id", "dim", "exact").distinct()
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    # Round-robin: a block has its share of the queries, and a few more at most.
    asked = kept(asked.repartition(n_blocks).withColumn("block", F.spark_partition_id()), "va-queries")
    out = scratch(spark, "va-hits")
    for b in range(n_blocks):
        rows = asked.filter(F.col("block") == b).select("id", "dim", "exact").toArrow()
        blocks = {}
        for batch in rows.combine_chunks().to_batches():
            for d, at in _by_dim(batch):
                blocks[d] = (at + 0, batch.column("id").to_numpy()[at], _matrix(batch.column("exact"), at, d, "<i4").astype(np.int64))
        sent = spark.sparkContext.broadcast((blocks, g))
        hits = file.mapInArrow(lambda it, sent=sent: _search(*sent.value, k, it), HIT)
        hits.withColumn("block", F.lit(b)).write.mode("append").parquet(out)
        sent.destroy()
    hits = spark.read.schema(f"{HIT}, block int").parquet(out)
    place = F.row_number().over(Window.partitionBy("block", "query").orderBy(F.desc("score"), "vec_id"))
    ranked = hits.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_va_file_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, "vec_id", "embedding")


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_inner_product(q.c, v.c) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM scored
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
"""
