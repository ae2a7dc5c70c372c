"""Exact top-k by inner product, pruned by multi-resolution segment statistics.

For integer vectors q and v the squared distance is |q|^2 + |v|^2 - 2 q.v, so a lower bound of
the distance is an upper bound of the product. With each vector cut into segments of length L,
means m and deviations s of the segments bound the distance from below:

    |q - v|^2 >= sum over segments of L ((m_q - m_v)^2 + (s_q - s_v)^2)

Coarse segments sift the candidates first, finer ones what is left, and the products of the
survivors are computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import id_type
from millrace.session import materialize

SCALE = 1024
QUERY_BLOCK = 8192
TILE = 2048
QUERY_TILE = 64
SEGMENTS = (4, 16)
SLACK = 1e-9


def quantised(vectors: DataFrame, *, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector``: floor(scale * x) of each component as a whole double.

    Vectors that are null, empty or hold null or non-finite components are left out, and so are
    rows without an id.
    """
    raw = vectors.filter(F.col(id_col).isNotNull() & (F.size(vector_col) > 0)).select(
        F.col(id_col).alias("vec_id"), F.transform(vector_col, lambda x: x.cast("double")).alias("raw"))
    finite = F.forall("raw", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))  # NaN is the largest number
    return raw.filter(finite).select("vec_id", F.transform("raw", lambda x: F.floor(x * scale).cast("double")).alias("vector"))


class Block:
    """Integer vectors of one length with the segment statistics of every resolution."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.largest = np.abs(vectors).max(initial=0.0)
        self.points = []
        for count in SEGMENTS:
            if vectors.shape[1] % count == 0 and vectors.shape[1] > count:
                length = vectors.shape[1] // count
                cut = vectors.reshape(len(vectors), count, length)
                # scaled by the root of the length, so that the bound is a plain squared distance
                self.points.append(np.concatenate([cut.mean(2), cut.std(2)], 1) * np.sqrt(length))

    def exact(self, other: Block, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Inner products of pairs of rows, exact; an error if they may not fit a long."""
        bound = self.largest * other.largest * self.vectors.shape[1]
        if bound < 2**53:
            return np.einsum("ij,ij->i", self.vectors[rows], other.vectors[columns]).astype(np.int64)
        if bound < 2**63:
            return np.einsum("ij,ij->i", self.vectors[rows].astype(np.int64), other.vectors[columns].astype(np.int64))
        raise OverflowError("inner products beyond 64 bits")


def upper_bounds(queries: Block, candidates: Block, level: int) -> np.ndarray:
    """At least the inner product of each query and candidate, from the segment statistics of a level."""
    q, c = queries.points[level], candidates.points[level]
    # |q|^2 + |v|^2 - lower bound of the squared distance, halved
    gap = (queries.norms - np.einsum("ij,ij->i", q, q))[:, None] + (candidates.norms - np.einsum("ij,ij->i", c, c))[None]
    bound = gap / 2 + q @ c.T
    return bound + SLACK * (np.abs(bound) + queries.norms[:, None] + candidates.norms[None]) + 1e-6


class Best:
    """The k best (score, id) so far of each query of a block: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.zeros((n, k), np.int64)
        self.count = np.zeros(n, np.int64)

    def floor(self) -> np.ndarray:
        """Scores below it no longer matter."""
        return np.where(self.count >= self.k, self.scores[:, -1], np.iinfo(np.int64).min)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((-scores, ids, rows))
        again = np.append(False, (np.diff(rows[order]) == 0) & (np.diff(ids[order]) == 0))
        order = order[~again]  # of the rows of an id the best one
        order = order[np.lexsort((ids[order], -scores[order], rows[order]))]
        rows, scores, ids = rows[order], scores[order], ids[order]
        starts = np.flatnonzero(np.append(True, np.diff(rows) != 0))
        for start, stop in zip(starts.tolist(), np.append(starts[1:], len(rows)).tolist()):
            row, n = rows[start], self.count[rows[start]]
            stop = min(stop, start + self.k)
            both = np.append(self.scores[row, :n], scores[start:stop])
            names = np.append(self.ids[row, :n], ids[start:stop])
            best = np.lexsort((names, -both))
            _, first = np.unique(names[best], return_index=True)  # an id counts once, by its best row
            best = best[np.sort(first)][: self.k]
            self.count[row] = len(best)
            self.scores[row, : len(best)], self.ids[row, : len(best)] = both[best], names[best]


def search_tile(queries: Block, candidates: Block, best: Best, offset: int) -> None:
    """Let the queries (rows ``offset`` onwards of ``best``) meet all candidates, coarse to fine to exact."""
    n, m = len(queries.ids), len(candidates.ids)
    span = np.arange(offset, offset + n)
    other = queries.ids[:, None] != candidates.ids[None]
    alive = other
    if queries.points:
        bounds = np.where(other, upper_bounds(queries, candidates, 0), -np.inf)
        if m > best.k and (best.count[span] < best.k).any():
            # the candidates with the highest bounds give every query a floor to start from
            top = np.argpartition(-bounds, best.k - 1, axis=1)[:, : best.k]
            rows, columns = np.repeat(np.arange(n), best.k), top.ravel()
            keep = other[rows, columns]
            rows, columns = rows[keep], columns[keep]
            best.add(rows + offset, queries.exact(candidates, rows, columns), candidates.ids[columns])
            other[rows, columns] = False
        floor = best.floor()[span][:, None]
        alive = other & (bounds >= floor)
    rows, columns = np.nonzero(alive)
    for level in range(1, len(queries.points)):
        if not len(rows):
            return
        q, c = queries.points[level], candidates.points[level]
        bound = (queries.norms[rows] - np.einsum("ij,ij->i", q, q)[rows] + candidates.norms[columns]
                 - np.einsum("ij,ij->i", c, c)[columns]) / 2 + np.einsum("ij,ij->i", q[rows], c[columns])
        bound += SLACK * (np.abs(bound) + queries.norms[rows] + candidates.norms[columns]) + 1e-6
        kept = bound >= best.floor()[rows + offset]
        rows, columns = rows[kept], columns[kept]
    if len(rows):
        scores = queries.exact(candidates, rows, columns)
        kept = scores >= best.floor()[rows + offset]
        if kept.any():
            best.add(rows[kept] + offset, scores[kept], candidates.ids[columns[kept]])


def top_products(
    vectors: DataFrame, is_query: Column, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = SCALE, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` rows with the highest integer inner product for each query row: ``query_id, rank, vec_id, score``.

    ``is_query`` is a condition on ``vec_id``. Candidates are the rows of another id and the same
    length. Equal scores rank by smaller id; a query with fewer candidates has fewer rows. Rows
    repeated under one id are one candidate, by the best of them, and one query, the least vector
    of the id. Ids are whole numbers. An empty table gives no rows.

    Queries go out in blocks of ``query_block``, so a broadcast never exceeds that many vectors;
    each block meets the stored candidates in one scan. A task keeps the k best per query, and
    those few rows are ranked together.
    """
    if id_type(vectors, id_col) not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("ids must be integers")
    rows = quantised(vectors, id_col=id_col, vector_col=vector_col, scale=scale)
    stored = materialize(rows.select(F.col("vec_id").cast("long"), "vector"))
    # numbered by blocks of ids, so that each block is read by a pushed filter
    queries = materialize(stored.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")))
    total = queries.count()
    blocks = max(1, -(-total // query_block))
    cuts = queries.approxQuantile("vec_id", [i / blocks for i in range(1, blocks)], 0.1 / blocks) if blocks > 1 else []
    edges = [None, *sorted({int(c) for c in cuts}), None]
    found = None
    for low, high in zip(edges, edges[1:]):
        block = queries
        if low is not None:
            block = block.filter(F.col("vec_id") > low)
        if high is not None:
            block = block.filter(F.col("vec_id") <= high)
        part = _search(stored, block, k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _by_length(ids: list[int], vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    groups: dict[int, tuple[list, list]] = {}
    for i, v in zip(ids, vectors):
        own = groups.setdefault(len(v), ([], []))
        own[0].append(i)
        own[1].append(v)
    return {n: (np.array(i, np.int64), np.array(v, np.float64)) for n, (i, v) in groups.items()}


def _search(stored: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """Partial results of one block of queries: each task's k best, at most."""
    asked = block.toArrow()
    shared = stored.sparkSession.sparkContext.broadcast(_by_length(
        asked["vec_id"].to_pylist(), [np.array(v, np.float64) for v in asked["vector"].to_pylist()]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = {n: [Block(i[a : a + QUERY_TILE], v[a : a + QUERY_TILE]) for a in range(0, len(i), QUERY_TILE)]
                 for n, (i, v) in shared.value.items()}
        best = {n: Best(len(i), k) for n, (i, _) in shared.value.items()}
        for batch in batches:
            lists = batch.column("vector")
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets)
            for n in np.unique(sizes).tolist():
                if n not in best:
                    continue
                where = np.flatnonzero(sizes == n)
                for a in range(0, len(where), TILE):
                    at = where[a : a + TILE]
                    own, vectors = ids[at], flat[offsets[at][:, None] + np.arange(n)]
                    if len(np.unique(own)) < len(own):  # equal rows of a tile count once
                        _, first = np.unique(np.column_stack([own, vectors.view(np.int64)]), axis=0, return_index=True)
                        own, vectors = own[first], vectors[first]
                    candidates = Block(own, vectors)
                    for j, tile in enumerate(tiles[n]):
                        search_tile(tile, candidates, best[n], j * QUERY_TILE)
        for n, (names, _) in shared.value.items():
            own = best[n]
            row, place = np.nonzero(np.arange(own.k)[None] < own.count[:, None])
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[row]), pa.array(own.ids[row, place]), pa.array(own.scores[row, place])],
                    ["query_id", "vec_id", "score"])

    return stored.mapInArrow(search, "query_id long, vec_id long, score long")
