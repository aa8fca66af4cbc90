"""Exact top-k search by columnar branch and bound.

Vectors lie in blocks, dimension by dimension. For each query a block's inner products are accumulated over one group of
dimensions after another; what the dimensions not yet seen can add is bounded by the remaining mass, the product of the
two remaining lengths. Candidates that can't reach the k-th best score so far are dropped and the survivors compacted
before the next group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from .common import discard, materialise, scratch_path

#: Queries that are sent to the executors at once; with 64 dimensions these are 4 MB.
QUERY_BLOCK = 8192
#: Vectors of a block in vertical layout, and dimensions of a group.
BLOCK_ROWS = 8192
GROUP = 16
#: Sums of products stay exact in doubles below this.
EXACT = float(1 << 52)
LONG = (-(1 << 63), (1 << 63) - 1)


def _valid(vector) -> F.Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


class Best:
    """The k best (score, id) of one query, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def lengths_left(columns: np.ndarray) -> list[np.ndarray]:
    """For each group of dimensions the length of what comes after it, a little too long rather than too short."""
    squares = columns * columns
    after = [np.sqrt(squares[at + GROUP :].sum(axis=0)) * (1 + 1e-9) for at in range(0, len(columns), GROUP)]
    return after or [np.zeros(columns.shape[1])]


def search_block(query: np.ndarray, left: list[float], own: int, columns: np.ndarray, after: list[np.ndarray], ids: np.ndarray, best: Best) -> None:
    """Put the block's vectors, ``columns`` by dimension, into ``best``; those of the query's own id take no part."""
    alive = np.flatnonzero(ids != own)
    total = np.zeros(len(alive))
    whole = len(alive) == len(ids)
    for g, at in enumerate(range(0, len(query), GROUP)):
        part = columns[at : at + GROUP]
        total = total + query[at : at + GROUP] @ (part if whole else part[:, alive])
        bound = total + left[g] * (after[g] if whole else after[g][alive])
        keep = bound >= best.least
        if not keep.all():
            alive, total, whole = alive[keep], total[keep], False
            if not len(alive):
                return
    if len(alive):
        if len(alive) > 4 * best.k:  # all that tie with the k-th score go on
            edge = np.partition(total, len(total) - best.k)[len(total) - best.k]
            at_least = total >= edge
            alive, total = alive[at_least], total[at_least]
        best.add(total.astype(np.int64), ids[alive])


def _exact_search(query: list[int], own: int, rows: list[list[int]], ids: list[int], k: int) -> list[tuple[int, int]]:
    """Plain integers, for components so large that doubles don't hold the sums. Scores end at the limits of long."""
    clip = lambda x: max(LONG[0], min(LONG[1], x))
    found = [(clip(sum(a * b for a, b in zip(query, r, strict=True))), i) for r, i in zip(rows, ids, strict=True) if i != own]
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def top_k(vectors: DataFrame, k: int = 10, scale: float = 1024.0, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each query, a row whose id is divisible by ``every``, the ``k`` rows of the largest inner product.

    Components x count as floor(scale * x); vectors that are null or hold a null, NaN or infinite component take no part,
    nor do rows with a null id. A query meets vectors of its own number of dimensions; with none, all scores are 0. Rows
    that share a query's id are its own and no candidates of it; a repeated id among candidates counts row by row, and a
    repeated query id is one query, that of its smallest vector. Scores beyond long end at its limits. Ties go to the
    smaller id. An empty table gives an empty result; other columns are ignored.

    Queries are written once, in blocks of about QUERY_BLOCK. Block after block goes out; each is one pass over all vectors,
    in which every task keeps k candidates a query, and these are ranked by query. With more than one block each block's
    result is written before the next one goes out, so that the driver and the executors hold one block at a time.

    Returns query_id, rank (from 1), vec_id, score.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & _valid(F.col("v")))
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = materialise(queries, "top-queries")
    n = queries.count()
    parts = max(1, -(-n // QUERY_BLOCK))
    path = scratch_path(spark, "top-found")
    for part in range(parts):
        chosen = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).orderBy("vec_id").collect()  # about QUERY_BLOCK
        found, sent = _search(rows, [(r[0], r[1]) for r in chosen], k, scale)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
        # ids may repeat, so that rows of one score and id are told apart by their number
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if parts == 1:
            return found
        found.write.mode("append").parquet(path)
        sent.destroy()
    discard(queries)
    return spark.read.parquet(path)


def _search(rows: DataFrame, queries: list[tuple[int, list[float]]], k: int, scale: float) -> tuple[DataFrame, Broadcast]:
    """The candidates of one block of queries, and what was sent out for them."""
    sizes = sorted({len(v) for _, v in queries})
    packed = {}
    for d in sizes:
        own = [(i, v) for i, v in queries if len(v) == d]
        with np.errstate(over="ignore"):
            packed[d] = (np.array([i for i, _ in own], np.int64), np.floor(np.array([v for _, v in own], np.float64).reshape(len(own), d) * scale))
    sent = rows.sparkSession.sparkContext.broadcast(packed)  # QUERY_BLOCK vectors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = sent.value
        best = {d: [Best(k) for _ in ids] for d, (ids, _) in packed.items()}
        large: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(start, BLOCK_ROWS)
                ids = np.asarray(piece.column(0))
                vectors = piece.column(1)
                sizes = np.diff(np.asarray(vectors.offsets, dtype=np.int64))
                flat = np.asarray(vectors.flatten(), dtype=np.float64)
                at = np.concatenate(([0], np.cumsum(sizes)))
                for d, (qids, q) in packed.items():
                    mine = np.flatnonzero(sizes == d)
                    if not len(mine) or not len(qids):
                        continue
                    x = np.floor(flat[(at[mine][:, None] + np.arange(d)).ravel()].reshape(len(mine), d) * scale)
                    top = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(d, 1)
                    if not top < EXACT:
                        whole = [[int(c) for c in r] for r in x]
                        for j, i in enumerate(qids.tolist()):
                            more = _exact_search([int(c) for c in q[j]], i, whole, ids[mine].tolist(), k)
                            large[d, j] = sorted(large.get((d, j), []) + more, key=lambda r: (-r[0], r[1]))[:k]
                        continue
                    columns = np.ascontiguousarray(x.T)
                    after = lengths_left(columns)
                    for j, i in enumerate(qids.tolist()):
                        left = [float(c[0]) for c in lengths_left(q[j][:, None])]
                        search_block(q[j], left, i, columns, after, ids[mine], best[d][j])
        for d, (qids, _) in packed.items():
            for j, i in enumerate(qids.tolist()):
                b = best[d][j]
                found = list(zip(b.scores.tolist(), b.ids.tolist(), strict=True)) + large.get((d, j), [])
                found = sorted(found, key=lambda r: (-r[0], r[1]))[:k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(found), pa.int64()), pa.array([r[1] for r in found], pa.int64()), pa.array([r[0] for r in found], pa.int64())],
                    ["query_id", "vec_id", "score"],
                )

    return rows.mapInArrow(run, "query_id long, vec_id long, score long"), sent
